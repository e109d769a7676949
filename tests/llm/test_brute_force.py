"""op1's method and op2's choice of documents, held against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from tessera.llm import mixing, url_filter


def _best_split(name: str, counts: Counter, total: int) -> list[str]:
    """Of all splits the likeliest; of equals the one with the shortest last word, then the last but one, and so on."""
    best = None
    for k in range(len(name)):
        for cuts in combinations(range(1, len(name)), k):
            words = [name[i:j] for i, j in zip((0, *cuts), (*cuts, len(name)))]
            if max(map(len, words)) > url_filter.MAX_WORD:
                continue
            logp = 0.0
            for w in words:
                logp += math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10)
            key = (logp, [-len(w) for w in reversed(words)])
            if best is None or key > best[0]:
                best = key, words
    return best[1]


def _ruled(host: str, path: str) -> str | None:
    fits = []
    for say, rule in url_filter.RULES:
        at = rule.index("/")
        if (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]):
            fits.append((len(rule), say))
    return max(fits)[1] if fits else None


def _judge(pages: list[tuple]) -> dict[int, tuple[str, float]]:
    counts, sites, judged, splits = Counter(), {}, {}, {}
    for _, _, html in pages:
        counts.update(re.findall("[a-z]{2,}", re.sub("<[^>]*>", " ", html).lower()))
    total = sum(counts.values())
    for page_id, url, _ in pages:
        rest = url.partition("://")[2] if url else ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = host.lower()
        names = ["0" if n.isdigit() else n for n in re.findall("[a-z0-9]+", f"{host}/{path}".lower())]
        for n in names:
            splits[n] = splits.get(n) or _best_split(n, counts, total)
        sites[page_id] = [w for n in names for w in splits[n]], _ruled(host, path)
    seen = Counter(say for _, say in sites.values() if say)
    words = {say: Counter(w for ws, s in sites.values() if s == say for w in ws) for say in ("allow", "block")}
    lap = len(words["allow"] | words["block"]) + 1
    score = {say: lambda w, c=c: math.log((c[w] + 1) / (sum(c.values()) + lap)) for say, c in words.items()}
    for page_id, (ws, say) in sites.items():
        z = math.log(seen["block"] / seen["allow"]) + sum(score["block"](w) - score["allow"](w) for w in ws)
        p = 1 / (1 + math.exp(-z))
        judged[page_id] = say or ("block" if p > 0.5 else "allow"), p
    return judged


def test_urls_by_viterbi_and_bayes(spark):
    rng = random.Random(3)
    words = ["good", "site", "rose", "odd", "go", "casino", "spam", "red", "den", "oddsite"]
    pages = []
    for k in range(300):
        host = "".join(rng.choice(words) for _ in range(rng.randint(1, 2))) + rng.choice([".com", ".net", ".org", ".example.org"])
        first = rng.choice(["/de/", "/fr/", "/x/", "/es/", "/en/"])
        url = f"http://{rng.choice(['', 'WWW.'])}{host}{first}{rng.choice(words)}{rng.choice(['zq', '', '/17', '-good'])}{rng.choice(['', '?q=spam', '#a'])}"
        pages.append((k, url, f"<p>{' '.join(rng.choice(words) for _ in range(rng.randint(0, 8)))} the</p>"))
    pages += [(300, None, ""), (301, "nothing", "site"), (302, "http://", "odd"), (303, pages[0][1], "red"), (304, pages[0][1], "red")]
    want = _judge(pages)
    got = {r["page_id"]: r for r in url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert len(got) == len(want) and {v for v, _ in want.values()} == {"allow", "block"}
    for k, (say, p) in want.items():
        assert got[k]["block_score"] == pytest.approx(p, rel=1e-6, abs=1e-12)
        assert got[k]["verdict"] == say or abs(p - 0.5) < 1e-9


def test_urls_with_a_column_of_each_name_in_use(spark):
    rows = [(1, "http://a.com/de/x", "<p>word</p>", "h", "p", "r", 1, "s"), (1, "http://a.com/de/x", "<p>word</p>", "h", "p", "r", 1, "s"), (2, "http://b.com/fr/x", None, "h", "p", "r", 1, "s")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string, rule string, n int, site string")
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages).collect())
    assert got == [(1, "a.com", "/de/x", "com/de/", "block")] * 2 + [(2, "b.com", "/fr/x", "com/fr/", "allow")]


def _taken(docs: list[tuple[int, int, int]], target: float) -> dict[int, int]:
    """Whole copies, then documents in order of their hash while they fit; what is left goes to later ones small enough."""
    total = sum(size for _, size, _ in docs)
    whole = min(math.floor(target / total), mixing.MAX_REPEAT) if total else 0
    times = {d: whole for d, _, _ in docs}
    room, rest = target - whole * total, sorted((h, size, d) for d, size, h in docs if size)
    for _ in range(mixing.PASSES):
        at = used = 0
        while at < len(rest) and used + rest[at][1] <= room:
            used += rest[at][1]
            times[rest[at][2]] += 1
            at += 1
        room -= used
        rest = [x for x in rest[at:] if x[1] <= room]
    return {d: size * min(times[d], mixing.MAX_REPEAT) for d, size, _ in docs}


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_takes_what_a_sort_would_take(spark, seed):
    rng = random.Random(seed)
    sources = ["a", "b", "c", "d", None]
    rows = [(k, "w " * rng.choice([0, 1, 3, 20, 200]), rng.choices(sources, [9, 30, 1, 4, 2])[0]) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    hashes = {r["doc_id"]: r["__h"] for r in mixing.with_keys(docs, "mix").select("doc_id", "__h").collect()}
    got = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    by_source, target = defaultdict(list), {}
    for k, text, source in rows:
        by_source[source].append((k, len(text.split()), hashes[k]))
        target[source] = got[k]["target"]
    for source, members in by_source.items():
        assert {k: got[k]["taken"] for k, _, _ in members} == _taken(members, target[source])


def test_words_across_pieces_of_a_long_name(spark, monkeypatch):
    """Names far longer than a piece are split as a whole; the pieces' ends cut no word."""
    rng = random.Random(8)
    words = {"garden": 40, "casino": 30, "gar": 5, "den": 5, "in": 9, "sin": 3, "or": 8, "abcdefghijklmnopqrstuvwx": 2}
    names = ["garden" * 33 + "casino" * 3, "zq" * 300, "casino" * 500, "a", *("".join(rng.choice([*words, "x", "zz"]) for _ in range(rng.randint(1, 90))) for _ in range(40))]
    total, want = sum(words.values()), {}
    for name in names:
        best = [(0.0, [])]
        for end in range(1, len(name) + 1):
            options = []
            for size in range(1, min(24, end) + 1):
                w = name[end - size : end]
                logp = math.log(words[w] / total) if w in words else math.log(10 / total) - size * math.log(10)
                options.append((best[end - size][0] + logp, -size))
            score, size = max(options)
            best.append((score, [*best[end + size][1], name[end + size : end]]))
        want[name] = best[-1][1]
    counts = spark.createDataFrame([*words.items()], "word string, n long")
    for piece in (256, 25, 7):
        monkeypatch.setattr(url_filter, "PIECE", piece)
        got = url_filter.segment_names(spark.createDataFrame([(n,) for n in {*names}], "name string"), counts)
        assert {r["name"]: list(r["words"]) for r in got.collect()} == want
    assert want[names[0]][-3:] == ["casino"] * 3
