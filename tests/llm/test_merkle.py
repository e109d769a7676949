"""op13 against a plain Python tree."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(r, extra: int = 0) -> str:
    row = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + extra, r["text"]]
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _up(level: list[str]) -> list[str]:
    return [_h(*level[i : i + 2]) for i in range(0, len(level), 2)]


def _path(level: list[str], at: int) -> tuple[list[tuple[int, str]], str]:
    """Siblings (side, hash; None where there is none) and the root."""
    found = []
    while len(level) > 1:
        other = at ^ 1
        found.append((other - at, level[other]) if other < len(level) else (0, ""))
        level, at = _up(level), at // 2
    return found, level[0]


def _fold(h: str, path) -> str:
    for side, other in path:
        h = _h(h) if not side else _h(other, h) if side < 0 else _h(h, other)
    return h


def _manifest(rows) -> list[tuple]:
    trees, out = defaultdict(list), []
    for r in rows:
        trees[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r), r))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for x in trees.values():
        x.sort(key=lambda y: y[:3])
    subroots = [_path([x[2] for x in trees[lang]], 0)[1] for lang in langs]
    for k, lang in enumerate(langs):
        high, root = _path(subroots, k)
        for at, (_, _, leaf, r) in enumerate(trees[lang]):
            low, subroot = _path([x[2] for x in trees[lang]], at)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            again = _fold(_leaf(r, int(hit)), low + high)
            out.append((r["doc_id"], leaf, subroot, root, _h(*(x for _, x in low + high)), again, again == root))
    return sorted(out, key=repr)


def _got(df) -> list[tuple]:
    out = merkle.manifest(df)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_trees_of_all_shapes(spark, monkeypatch, levels):
    """Trees of 1, 2, 3, 4, 5, 17 and 70 leaves, in one or several buckets of levels."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    sizes = [1, 2, 3, 4, 5, 17] if levels == 1 else [1, 2, 3, 4, 5, 17, 70]
    rows = [(100 * k + i, f"text é {i}", None if k == 3 else f"l{k}", "s", None if i % 5 == 4 else i) for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = _got(df)
    assert got == _manifest(df.collect())
    assert {r[-1] for r in got} == {True, False}


def test_merkle_edges(spark, odd_docs, no_docs):
    assert _got(odd_docs) == _manifest(odd_docs.collect())
    assert _got(no_docs) == []
    one = odd_docs.limit(1)
    (got,) = _got(one)
    assert got[1] == got[2] == got[3] and got[4] == _h() and got == _manifest(one.collect())[0]


def test_merkle_of_repeated_rows_and_clashing_names(spark):
    """A third of all rows alike; columns named like those that the operator makes."""
    rows = [(7, "same", "en", "a", 4)] * 40 + [(k, f"t{k}", "en", "a", 2) for k in range(60)] + [(None, "x", "en", None, None)] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.withColumns({n: F.lit("x") for n in ("g", "at", "size", "hash", "leaf", "level", "lo", "hi", "block", "salt", "told", "path")}).repartition(3)
    assert _got(df) == _manifest(df.collect())


def test_blocks_bound_what_a_task_gathers(spark):
    df = spark.range(500).select(F.lit("g").alias("g"), F.lit(500).cast("long").alias("size"), F.col("id").alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    built = merkle.build(df, 0)
    assert built.agg(F.max(F.size("h0"))).first()[0] == 1 << merkle.LEVELS and built.count() == 8
    met = merkle.siblings(built, 0)
    assert met.count() == 500 and met.agg(F.max(F.size("path"))).first()[0] == merkle.LEVELS
