import random
import re
import unicodedata
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

from pyspark.sql import functions as F

from feedjobs.functions import text as X
from feedjobs.functions.times import in_business_day, parse_time
from feedjobs.functions.urls import TRACKING, canonical_url
from feedjobs.operators.runs import error_class

URLS = [
    ("https://Example.com/Path/?utm_source=x&b=2&a=1#frag", "https://example.com/Path?a=1&b=2"),
    ("HTTPS://EXAMPLE.COM/", "https://example.com/"),
    ("https://example.com", "https://example.com"),
    ("https://example.com/a//?ref=hn&fbclid=1", "https://example.com/a"),
    ("https://example.com/?UTM_source=1", "https://example.com/?UTM_source=1"),
    ("https://example.com/?k", "https://example.com/?k="),
    ("https://example.com/?q=a%20b*~", "https://example.com/?q=a+b%2A~"),
]


def values(spark, column, rows):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string").orderBy("i").select(column(F.col("x"))).collect()]


def test_canonical_url(spark):
    assert values(spark, canonical_url, [u for u, _ in URLS]) == [c for _, c in URLS]


def test_canonical_url_reads_queries_as_web_forms_do(spark):
    rng = random.Random(4)
    urls = ["/only/a/path/?b=1&a", "mailto:x@e.com?subject=a%2", "//e.com/x//", "http://E.com?x=1", "a b", "", "http://e.com/?=v&&k=%FF"]
    urls += [" https://E.com/a/", "\t\n https://E.com/a/ ", "ht\ntps://E.\tcom/a\r/?x=1\n", "\x00\x1fhttp://E.com/", " ", "\u00a0http://E.com/A/", "//E.com/\n/"]
    urls += [rng.choice(["", " ", "\n", "\x01 "]) + "https://E.com/p/?" + "".join(rng.choice(["a", "b", "Z", "é", "=", "&", "%", "%2", "%41", "%C3%A9", "+", "*", "~", "-", "utm_", "ref=", "%zz", " ", ";", "/", "\t", "\r"]) for _ in range(12)) for _ in range(300)]
    want = []
    for u in urls:
        p = urlsplit(u)
        kept = sorted((k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if not k.startswith("utm_") and k not in TRACKING)
        want.append(urlunsplit((p.scheme, p.netloc.lower(), p.path if p.path == "/" else p.path.rstrip("/"), urlencode(kept), "")))
    assert values(spark, canonical_url, urls) == want


def test_normalize_title(spark):
    assert values(spark, X.normalize_title, ["  Hello,   World!  ", "ＡＢＣ－１", "snake_case", "!!!", None]) == ["hello world", "abc 1", "snake_case", "", None]


def test_redact_and_counts(spark):
    assert values(spark, X.redact, ["GET /a?token=abc&x=1&KEY=z", "no secret"]) == ["GET /a?token=***&x=1&KEY=***", "no secret"]
    assert values(spark, X.parse_count, ["1,234", "1.2k", "12", "many", "k", ""]) == [1234, 1200, 12, 0, 0, 0]


def test_clean_comment(spark):
    assert values(spark, X.clean_comment, ["<p>a &amp; b</p>  c", "x" * 301]) == ["a & b c", "x" * 300 + "…"]


def test_error_class(spark):
    cases = {"HTTPStatusError: 503 x": "transient", "HTTPStatusError: 403 x": "user_action_required", "HTTPStatusError: 429 x": "persistent_error", "ReadTimeout: ": "transient", "NetworkError: x": "transient", "CloseError: x": "transient", "TimeoutException: x": "persistent_error", "RemoteProtocolError: 404": "transient", "ConnectionError: x": "persistent_error", "ValueError: 500": "persistent_error"}
    assert values(spark, error_class, list(cases)) == list(cases.values())


def test_times(spark):
    rows = ["2026-04-25T22:28:19Z", "2026-04-25T22:28:19+0000", "Sat Apr 25 22:28:19 +0000 2026", "Sat, 25 Apr 2026 22:28:19 +0000", "nonsense"]
    got = values(spark, lambda c: parse_time(c, F.lit("2000-01-01").cast("timestamp_ntz")).cast("string"), rows)
    assert got == ["2026-04-25 22:28:19"] * 4 + ["2000-01-01 00:00:00"]
    edges = ["2026-04-25 15:59:59", "2026-04-25 16:00:00", "2026-04-25 22:05:00", "2026-04-26 15:59:59", "2026-04-26 16:00:00"]
    assert values(spark, lambda c: in_business_day(c.cast("timestamp_ntz"), "2026-04-26"), edges) == [False, True, True, True, False]


def test_titles_in_their_own_form_need_no_python(spark, monkeypatch):
    """Each character of OWN_FORM is its own NFKC form and joins none before it, so only other texts are sent."""
    own = [c for c in map(chr, range(0x80, 0x10000)) if re.match(f"[{X.OWN_FORM}]", c)]
    second = {d.split()[1] for d in map(unicodedata.decomposition, map(chr, range(0x110000))) if len(d.split()) == 2 and d[0] != "<"}
    assert all(unicodedata.is_normalized("NFKC", c) and not unicodedata.combining(c) and f"{ord(c):04X}" not in second and not 0x1160 <= ord(c) <= 0x11FF for c in own)
    texts = ["Él – día 日本", "plain", "ﬁne", "é", "a…", "𝐀", None]
    want = values(spark, X.normalize_title, texts)
    assert want == ["él día 日本", "plain", "fine", "é", "a", "a", None]
    monkeypatch.setattr(X, "nfkc", lambda text: F.when(text.isNotNull(), F.lit("sent")))
    assert values(spark, X.normalize_title, texts) == ["él día 日本", "plain", "sent", "sent", "sent", "sent", None]
