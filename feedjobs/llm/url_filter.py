"""URL filter: rules first, else logistic regression on hashed character n-grams.

DataFrame functions and Spark's own ML pipeline only; no Python runs in tasks.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedjobs.operators.lineage import scratch

#: Buckets for n-grams, and their lengths.
BUCKETS, SIZES = 1 << 16, (3, 4, 5)
#: Rules that become one expression; more are joined.
EXPRESSION = 100

# Names that unwanted hosts are made of (gambling, medicines, adult pages, easy money, advertising, copies), and names of ordinary ones.
UNWANTED = """
casinos poker roulette blackjack jackpot slots betting sportsbook bookmaker lottery lotto gamble wager bingo scratchcard
viagra cialis pharmacy pharma pillstore meds steroid painkiller diet-pill weightloss botox rx-online
porn xxx sexy adults erotic nude escort hookup camgirls fetish milf hentai
payday loans credit-fix forex binary-option crypto-profit bitcoin-double get-rich earn-cash moneymaker giveaway freebies prizes winner bonus coupons cheapest discount replica outlet-sale
adserver adclick adnetwork popunder doubleclicks tracker trackingpixel clickbank banners affiliate traffic-boost backlinks seo-spam spammer bulkmail malware phishing
torrent warez keygen cracked nulled pirated streamz free-download
""".split()
ORDINARY = """
wikipedia github mozilla apache debian kernel ubuntu python-docs rust-lang haskell archive openlibrary gutenberg
guardian reuters times tribune herald observer gazette economist spiegel lemonde elpais zeitung courier journal
university college institute school academy library museum gallery theatre cinema orchestra opera
hospital clinic council ministry parliament senate courts police embassy treasury census
nature science physics chemistry biology astronomy geology mathematics statistics engineering robotics
weather railway airport station harbour bridge mountain river island forest garden village
football cricket tennis cycling chess hiking sailing climbing marathon stadium
recipes kitchen bakery coffee brewery vineyard restaurant market farmers grocery
bookshop furniture hardware clothing shoes jewellery florist pottery carpentry textile
insurance banking accounting lawyers architects consulting publishing printing logistics shipping
music guitar piano painting photography poetry history philosophy language dictionary translation
parents children teachers students neighbours volunteers charity church temple community
software database network security hosting developer compiler editor forum support manual
""".split()
PATHS = ["/", "", "/index.html", "/page/2", "/accueil", "/seite", "/news/article-17.html"]
SITES, UNWANTED_ENDS, ORDINARY_ENDS = ["", "www.", "m.", "blog.", "news."], [".com", ".net", ".xyz", ".top", ".click", ".info"], [".com", ".net", ".org", ".edu", ".de", ".co.uk"]


def labelled() -> tuple[list[str], list[str]]:
    """Unwanted and ordinary addresses: hosts of one name, and of two that stand some way apart in their list, each with one of the paths."""
    made = []
    for names, ends in ((UNWANTED, UNWANTED_ENDS), (ORDINARY, ORDINARY_ENDS)):
        n = len(names)
        hosts = names + [("-" if step % 2 else "").join((names[i], names[(i + step) % n])) for step in (6, 11, 15) for i in range(n)]
        made.append([f"http://{SITES[i % 5]}{h}{ends[i % 6]}{PATHS[i % 7]}" for i, h in enumerate(hosts)])
    return made[0], made[1]


BLOCKED, ALLOWED = labelled()


def seed_urls(spark: SparkSession) -> DataFrame:
    """url, label (1.0: block): the small labelled table, whose size is fixed and which was written without regard to the pages that are judged."""
    kinds = [F.explode(F.array(*[F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u in urls])) for y, urls in ((1.0, BLOCKED), (0.0, ALLOWED))]
    one = spark.range(0, 1, 1, 1)
    return one.select(kinds[0].alias("r")).union(one.select(kinds[1].alias("r"))).select("r.url", "r.label").coalesce(1)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty without ``://``. Only A to Z change case."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def grams(chars: Column, mark: str) -> Column:
    """All n-grams of a text that was split into characters, marked; those of a length that the text lacks are none.

    A gram joins neighbours by their places, so the work grows with the text's length.
    """
    size = F.size(chars)

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(size - n, F.lit(0)))
        found = F.transform(starts, lambda i: F.concat(F.lit(mark), *[F.get(chars, i + k) for k in range(n)]))
        return F.when(size >= n, found).otherwise(F.array().cast("array<string>"))

    return F.concat(*map(of, SIZES))


def with_features(df: DataFrame) -> DataFrame:
    """Adds _f, the hashed n-grams of host and path (empty parts have none); a part's ends are ``^`` and ``$``."""
    host, path = host_and_path(F.col("_url"))
    split = {m: F.when(c != "", F.split(F.concat(F.lit("^"), c, F.lit("$")), "")).otherwise(F.array().cast("array<string>")) for m, c in (("h", host), ("p", path))}
    rows = df.withColumns({f"_{m}": c for m, c in split.items()})  # split once: each gram reads them
    rows = rows.withColumn("_grams", F.concat(*[grams(F.col(f"_{m}"), f"{m}:") for m in split])).drop("_h", "_p")
    return HashingTF(numFeatures=BUCKETS, inputCol="_grams", outputCol="_f", binary=True).transform(rows)


#: Weight of an unwanted row: ordinary names are more, and a page on a host of unknown kind is to be judged by the unwanted names it shows.
UNWANTED_WEIGHT = 4.0


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """Fit on (url, label); 1.0 means block. The table is small and its rows stand once.

    The model is saved and read again, which leaves out its training summary: that holds the session, which can't go with a task once the session has observed metrics.
    """
    rows = with_features(labelled.withColumnRenamed("url", "_url")).withColumn("_w", F.when(F.col("label") == 1.0, UNWANTED_WEIGHT).otherwise(1.0))
    fitted = LogisticRegression(featuresCol="_f", labelCol="label", weightCol="_w", probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_y", maxIter=60, regParam=0.003, standardization=False).fit(rows)
    path = scratch(labelled.sparkSession)
    fitted.save(path)
    return LogisticRegressionModel.load(path)


def _order(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The rule that wins comes last: the longest; of these a block; of these the one that sorts first."""
    return sorted(sorted(rules, key=lambda r: r[1], reverse=True), key=lambda r: (len(r[1]), r[0] == "block"))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The fitting rule that wins (see _order) and its verdict, or nulls. A rule is ``host/path``; it fits subdomains too."""
    name = verdict = F.lit(None).cast("string")
    for decision, rule in _order(rules):
        site, _, rest = rule.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith("/" + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def with_rules(rows: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds rule and _verdict to rows with host and path. A few rules are one expression; many are a table.

    Then each host and path, once, meets the rules of its own domains and of the leading parts of its path that are as long as a rule's, so
    that a domain with many rules makes no more rows than it has lengths of paths.
    """
    if len(rules) <= EXPRESSION:
        name, verdict = rule_of(F.col("host"), F.col("path"), rules)
        return rows.withColumn("rule", name).withColumn("_verdict", verdict)
    last = {rule: (decision, i) for i, (decision, rule) in enumerate(_order(rules))}
    parts = [(*rule.partition("/")[::2], rule, decision, i) for rule, (decision, i) in last.items()]
    table = rows.sparkSession.createDataFrame([(site, "/" + rest, rule, d, i) for site, rest, rule, d, i in parts], "_site string, _start string, rule string, _verdict string, _place int")
    lengths = table.groupBy("_site").agg(F.array_sort(F.collect_set(F.length("_start"))).alias("_lengths"))
    once = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    domains = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    met = once.select("host", "path", F.explode(domains).alias("_site")).join(lengths, "_site")
    met = met.select("host", "path", "_site", F.explode(F.transform("_lengths", lambda n: F.substring(F.col("path"), F.lit(1), n))).alias("_start")).distinct()
    best = met.join(table, ["_site", "_start"]).groupBy("host", "path").agg(F.max_by(F.struct("rule", "_verdict"), "_place").alias("_r"))
    best = best.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "_r.*")
    return rows.join(best, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left").drop("_h", "_p")


def judge(pages: DataFrame, model: LogisticRegressionModel, rules: list[tuple[str, str]], *, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Allow or block every url; one row a page.

    Returns page_id, host, path, rule, verdict, probability (of block, by the model). The longest rule that
    fits decides (of equally long ones a block, then the one that sorts first), else the model. A null url or one without ``://`` has an empty host
    and path, so no n-grams, and is allowed. Very long urls are read whole;
    repeated rows are judged alike; other columns are not read.
    """
    rows = with_features(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url")))
    host, path = host_and_path(F.col("_url"))
    rows = model.transform(rows).select("page_id", host.alias("host"), path.alias("path"), vector_to_array("_p")[1].alias("probability"))
    rows = with_rules(rows, rules)
    chosen = F.coalesce("_verdict", F.when((F.col("probability") >= threshold) & (F.concat("host", "path") != ""), F.lit("block")).otherwise(F.lit("allow")))
    return rows.select("page_id", "host", "path", "rule", chosen.alias("verdict"), "probability")
