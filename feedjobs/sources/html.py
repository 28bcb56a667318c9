"""Two small page readers, run over batches of pages (page_id, html)."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf


class _Repos(HTMLParser):
    """Rows of a repository list: in each article.Box-row the first link of its heading, its first paragraph and its first star link."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[dict[str, str]] = []
        self.inside = self.heading = False
        self.field: tuple[str, str] | None = None  # the tag that is open, and where its text goes

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "article" and "Box-row" in (a.get("class") or "").split():
            self.inside = True
            self.rows.append({})
        elif self.inside and tag == "h2":
            self.heading = True
        elif self.inside and tag == "a":
            href = a.get("href") or ""
            if self.heading:
                self.rows[-1].setdefault("slug", href.strip("/"))
            elif href.endswith("/stargazers") and "stars" not in self.rows[-1]:
                self.field = "a", "stars"
                self.rows[-1]["stars"] = ""
        elif self.inside and tag == "p" and "description" not in self.rows[-1]:
            self.field = "p", "description"
            self.rows[-1]["description"] = ""

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside = False
        elif tag == "h2":
            self.heading = False
        if self.field and tag in (self.field[0], "article"):
            self.field = None

    def handle_data(self, data):
        if self.field:
            self.rows[-1][self.field[1]] += data


def repo_lists(pages: DataFrame) -> DataFrame:
    """page_id, pos, slug, description, stars (text)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for page, text in zip(frame["page_id"], frame["html"], strict=True):
                reader = _Repos()
                reader.feed(text or "")
                rows += [(page, i, r["slug"], r.get("description", "").strip(), r.get("stars", "").strip()) for i, r in enumerate(reader.rows) if r.get("slug")]
            yield pd.DataFrame(rows, columns=["page_id", "pos", "slug", "description", "stars"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, pos long, slug string, description string, stars string")


_CHUNK = re.compile(r'self\.__next_f\.push\(\[\d+,\s*"((?:[^"\\]|\\.)*)"\]\)', re.S)
_NAME = re.compile(r'[{}]|"full_name"\s*:')
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]]', re.S)
#: Levels of braces and brackets that a record may have inside.
DEPTH = 64


def _decoded(chunk: str) -> str:
    """A script chunk's text; a damaged chunk has none."""
    try:
        return json.loads(f'"{chunk}"', strict=False)
    except ValueError:
        return ""


def object_starts(text: str) -> list[int]:
    """Where the objects begin that have a full_name of their own, each once and in order: one pass with a stack of open braces."""
    open_, starts = [], {}
    for m in _NAME.finditer(text):
        if m[0] == "{":
            open_.append(m.start())
        elif m[0] == "}":
            if open_:
                open_.pop()
        elif open_:
            starts[open_[-1]] = True
    return list(starts)


def object_at(text: str, start: int) -> str | None:
    """The object from this brace to the one that balances it, braces in strings left aside; None if there is none, or if it is more than DEPTH deep."""
    depth = 0
    for m in _TOKEN.finditer(text, start):
        if m[0] in "{[":
            depth += 1
            if depth > DEPTH:
                return None
        elif m[0] in "}]":
            depth -= 1
            if not depth:
                return text[start : m.end()]
    return None


def _record(text: str | None) -> tuple[tuple | None, str | None]:
    """((rank, score, full_name, description), None) of a record; (None, why) if it can't be one; (None, None) of an object of another kind."""
    if text is None:
        return None, f"unbalanced, or more than {DEPTH} levels deep"
    try:
        r = json.loads(text)
    except (ValueError, RecursionError):
        return None, "no JSON"
    if not all(k in r for k in ("rank", "score", "full_name")):
        return None, None
    try:
        rank, score = int(r["rank"]), float(r["score"])
    except (TypeError, ValueError, OverflowError):
        return None, "rank or score is no number"
    if not -(1 << 63) <= rank < 1 << 63 or not abs(score) < 1 << 63:  # also NaN
        return None, "rank or score is out of range"
    if not isinstance(r["full_name"], str):
        return None, "full_name is no text"
    return (rank, score, r["full_name"], str(r.get("description") or "")), None


def page_records(html: str | None) -> Iterator[tuple[int, tuple | None, str | None, str]]:
    """pos, record or None, why it is none or None, its text: the records of a streamed page in order, whatever the numbers of its chunks."""
    body = "".join(map(_decoded, _CHUNK.findall(html or "")))
    for pos, start in enumerate(object_starts(body)):
        found, why = _record(object_at(body, start))
        if found or why:
            yield pos, found, why, body[start : start + 200]


_RANKED = ["page_id", "pos", "rank", "score", "full_name", "description", "reason", "text"]


def _ranked(pages: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(page, pos, *(found or (None, None, None, None)), why, text if why else None) for page, html in zip(frame["page_id"], frame["html"], strict=True) for pos, found, why, text in page_records(html)]
            made = pd.DataFrame(rows, columns=_RANKED)
            yield made.astype({"rank": "Int64", "score": "Float64"})

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, pos long, rank long, score double, full_name string, description string, reason string, text string")


def ranked_repos(pages: DataFrame) -> DataFrame:
    """page_id, pos, rank, score, full_name, description of the records that a streamed page carries in its script chunks. What is damaged is left out (see damaged_records)."""
    return _ranked(pages).where("reason is null").drop("reason", "text")


def damaged_records(pages: DataFrame) -> DataFrame:
    """page_id, pos, reason, text (its first 200 characters): the quarantine of ranked_repos. The other records of the page, and other pages, are not touched by it."""
    return _ranked(pages).where("reason is not null").select("page_id", "pos", "reason", "text")


def register(spark: SparkSession) -> None:
    """Both readers as SQL table functions: ``SELECT p.page_id, r.* FROM pages p, LATERAL repo_list(p.html) r``, and ``ranked_records`` likewise."""

    @udtf(returnType="pos bigint, slug string, description string, stars string")
    class RepoList:
        def eval(self, html: str):
            reader = _Repos()
            reader.feed(html or "")
            yield from ((i, r["slug"], r.get("description", "").strip(), r.get("stars", "").strip()) for i, r in enumerate(reader.rows) if r.get("slug"))

    @udtf(returnType="pos bigint, rank bigint, score double, full_name string, description string, reason string")
    class RankedRecords:
        def eval(self, html: str):
            yield from ((pos, *(found or (None, None, None, None)), why) for pos, found, why, _ in page_records(html))

    spark.udtf.register("repo_list", RepoList)
    spark.udtf.register("ranked_records", RankedRecords)
