"""URL filters: rules first; else word segmentation of host and path names, then multinomial naive Bayes.

Names (host labels and path pieces) are split into words by a unigram Viterbi over word counts of the pages' own
text. Word counts, class counts and scores are relations: nothing of the vocabulary passes the driver.

Defined results: a null url, or one without `://`, has an empty host and path and no rule; repeated rows are judged
alike; with no rule-judged page of one class the method says allow; an empty table gives an empty result.
Other columns of the input are ignored. A word has MAX_WORD letters at most; a name may have any number. Substrings of a name are
looked up a piece of PIECE letters at a time, and Viterbi goes on from piece to piece, so only a byte a letter is held of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hot_safe_left_join, read, stash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, rule); a rule is a host, then the start of a path.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
MAX_WORD, PIECE = 24, 256
PIECES = r"[a-z0-9]+|[^\x00-\x7f]+"


def url_parts(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def site_name() -> Column:
    """A name of 128 bits of a host and path."""
    return F.md5(F.concat_ws("\n", "host", "path"))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict."""
    rule = verdict = None
    for say, text in sorted(rules, key=lambda r: -len(r[1])):
        at = text.index("/")
        fits = ((host == text[:at]) | F.endswith(host, F.lit("." + text[:at]))) & F.startswith(path, F.lit(text[at:]))
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, say) if verdict is None else verdict.when(fits, say)
    return (rule, verdict) if rules else (F.lit(None).cast("string"),) * 2


class Split:
    """Viterbi over one name: the most likely split; of equals the one with the shortest last word, then the last but one."""

    def __init__(self, name: str, total: int):
        self.name, self.total, self.at = name, total, 0
        self.best = [0.0] + [-math.inf] * MAX_WORD  # of the ends from `at` on
        self.back = bytearray(len(name) + 1)
        self.unknown = [math.log(10 / total) - size * math.log(10) for size in range(MAX_WORD + 1)]

    def advance(self, upto: int, found: dict[tuple[int, int], int]) -> None:
        """Go on with the words that start before `upto`; found maps (start, length) to a word's count."""
        for start in range(self.at, min(upto, len(self.name))):
            own = self.best[0]
            for size in range(1, min(MAX_WORD, len(self.name) - start) + 1):
                count = found.get((start, size), 0)
                score = own + (math.log(count / self.total) if count else self.unknown[size])
                if score >= self.best[size]:
                    self.best[size], self.back[start + size] = score, size
            self.best = [*self.best[1:], -math.inf]
        self.at = max(self.at, min(upto, len(self.name)))

    def words(self) -> list[str]:
        self.advance(len(self.name), {})
        out, end = [], len(self.name)
        while end:
            out.append(self.name[end - self.back[end] : end])
            end -= self.back[end]
        return out[::-1]


def segment(name: str, found: dict[tuple[int, int], int], total: int) -> list[str]:
    """Most likely split of a name; found maps (start, length) to a word's count."""
    split = Split(name, total)
    split.advance(len(name), found)
    return split.words()


def segment_names(names: DataFrame, word_counts: DataFrame) -> DataFrame:
    """(name) distinct and (word, n) -> (name, words). Substrings join the counts; Viterbi runs per name, piece after piece."""
    total = word_counts.agg(F.sum("n")).first()[0] or 1
    keyed = names.filter("length(name) > 0").select(F.md5("name").alias("key"), "name")
    parts = keyed.select("key", F.posexplode(F.expr(f"transform(sequence(0, (length(name) - 1) div {PIECE}), p -> substring(name, cast(p AS int) * {PIECE} + 1, {PIECE + MAX_WORD - 1}))")).alias("piece", "text"))
    # a word starts in a piece's own letters and may end in those that the next piece starts with
    words = F.expr(f"""flatten(transform(sequence(1, least({PIECE}, length(text))), i -> transform(sequence(1, least({MAX_WORD}, length(text) - i + 1)),
        k -> struct(piece * {PIECE} + i - 1 AS start, k AS size, substring(text, i, k) AS word))))""")
    parts = parts.select("key", "piece", F.explode(words).alias("w")).select("key", "piece", "w.*")
    hits = hot_safe_left_join(parts, word_counts, "word").filter("n IS NOT NULL")
    hits = hits.groupBy("key", "piece").agg(F.collect_list(F.struct("start", "size", "n")).alias("hits"))  # PIECE * MAX_WORD at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for b in batches:
            done = []
            for name, piece, found in zip(b["name"], b["piece"], b["hits"]):
                if piece < 0:  # a name comes before its pieces
                    done += [(now.name, now.words())] if now else []
                    now = Split(name, total)
                else:
                    now.advance(piece * PIECE, {})  # pieces without a known word are absent
                    now.advance((piece + 1) * PIECE, {(h["start"], h["size"]): h["n"] for h in found})
            yield pd.DataFrame(done, columns=["name", "words"])
        if now:
            yield pd.DataFrame([(now.name, now.words())], columns=["name", "words"])

    kind = dict(hits.dtypes)["hits"]
    rows = keyed.select("key", F.lit(-1).alias("piece"), "name", F.lit(None).cast(kind).alias("hits"))
    rows = rows.unionByName(hits.select("key", "piece", F.lit(None).cast("string").alias("name"), "hits"))
    return rows.repartition("key").sortWithinPartitions("key", "piece").mapInPandas(run, "name string, words array<string>")


def text_words(html: Column) -> Column:
    """Lower-case words of a page's visible text."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<[^>]*>|&\w+;", " ")
    return F.regexp_extract_all(F.lower(bare), F.lit(r"\p{L}{2,}"), F.lit(0))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """pages(page_id, url, html) -> page_id, host, path, rule, verdict, block_score."""
    p = stash(rule_verdicts(pages, rules), "urls")
    sites = p.groupBy("host", "path").agg(F.count("*").alias("n"), F.first("ruled").alias("ruled"))
    names = F.regexp_extract_all(F.lower(F.concat_ws("/", "host", "path")), F.lit(PIECES), F.lit(0))
    # digits say little but that they are digits
    names = F.transform(names, lambda x: F.when(x.rlike(r"^\d+$"), "0").otherwise(x))
    sites = stash(sites.withColumn("site", site_name()).withColumn("names", names), "sites")
    named = sites.select("site", "n", "ruled", F.explode("names").alias("name"))
    counts = pages.select(F.explode(text_words(F.col("html"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    split = stash(segment_names(named.select("name").distinct(), stash(counts, "words")), "split")

    by_name = named.filter("ruled IS NOT NULL").groupBy("name").agg(
        F.sum(F.when(F.col("ruled") == "block", F.col("n"))).alias("b"),
        F.sum(F.when(F.col("ruled") == "allow", F.col("n"))).alias("a"),
    ).fillna(0)
    model = by_name.join(split, "name").select(F.explode("words").alias("word"), "a", "b")
    model = stash(model.groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "nb")
    size, in_a, in_b = model.agg(F.count("*"), F.sum("a"), F.sum("b")).first()
    seen = {r["ruled"]: r["n"] for r in sites.filter("ruled IS NOT NULL").groupBy("ruled").agg(F.sum("n").alias("n")).collect()}
    if {"allow", "block"} - seen.keys():
        return p.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("block_score"))
    lap = size + 1
    llr = F.log((F.col("b") + 1) / (in_b + lap)) - F.log((F.col("a") + 1) / (in_a + lap))
    unseen = math.log(1 / (in_b + lap)) - math.log(1 / (in_a + lap))
    word_llr = model.select("word", llr.alias("llr"))
    name_words = split.select("name", F.explode("words").alias("word"))
    name_llr = hot_safe_left_join(stash(name_words, "name_words"), word_llr, "word")
    name_llr = name_llr.groupBy("name").agg(F.sum(F.coalesce("llr", F.lit(unseen))).alias("llr"))
    scored = hot_safe_left_join(named.select("site", "name"), stash(name_llr, "name_llr"), "name")
    site_llr = stash(scored.groupBy("site").agg(F.sum("llr").alias("llr")), "site_llr")
    prior = math.log(seen["block"] / seen["allow"])
    out = hot_safe_left_join(p.withColumn("site", site_name()), site_llr, "site")
    score = 1 / (1 + F.exp(-(F.coalesce("llr", F.lit(0.0)) + prior)))
    return out.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(score > 0.5, "block").otherwise("allow")).alias("verdict"), score.alias("block_score"),
    )


def rule_verdicts(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """pages -> page_id, host, path, rule, ruled: the part that needs no learning."""
    host, path = url_parts(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, say = rule_columns(F.col("host"), F.col("path"), rules)
    return p.select("*", rule.alias("rule"), say.alias("ruled"))


def url_rules(spark, sf_dir: str) -> DataFrame:
    return rule_verdicts(read(spark, sf_dir, "pages"))


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"))
