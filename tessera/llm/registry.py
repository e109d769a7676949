"""Queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from importlib import import_module

#: Query name -> its module.
MODULES = {
    "op1_url_filter": "url_filter",
    "op2_mix_sources": "mixing",
    "op3_toxicity": "toxicity",
    "op4_language_id": "langid",
    "op5_embedding_dedup": "embedding_dedup",
    "op6_lm_score": "lm_score",
    "op7_token_files": "tokens",
    "op8_simhash": "simhash",
    "op9_suffix_dedup": "suffix_dedup",
    "op10_decontaminate": "decontam",
    "op11_document_fingerprints": "fingerprints",
    "op12_token_alignment": "alignment",
    "op13_merkle_manifest": "merkle",
    "edited_texts": "fingerprints",
    "url_rules": "url_filter",
    "mix_targets": "mixing",
}

_RULES = [("example.org", "/en/1", "block"), ("example.org", "/es/", "block"), ("com", "/de/", "block"), ("com", "/fr/", "allow"), ("org", "/", "allow")]
_FITS = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in _RULES]

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
_TOLD = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "(n_chars + 1)", "text")) + ")"
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ord(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)"""

#: What SQL can express: op1's rules, op2's sizes and targets, op5 by all pairs.
SQL: dict[str, str] = {
    "url_rules": f"""SELECT page_id, host, path, CASE {' '.join(f"WHEN {f} THEN '{h}{p}'" for f, (h, p, _) in zip(_FITS, _RULES))} END AS rule,
        CASE {' '.join(f"WHEN {f} THEN '{v}'" for f, (_, _, v) in zip(_FITS, _RULES))} END AS ruled FROM (SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages))""",
    "mix_targets": r"""WITH RECURSIVE docs AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM docs GROUP BY 1),
        fill AS (SELECT 0 AS step, list(struct_pack(source := source, full_ := 3.0::DOUBLE * source_size, weight := weight, stopped := false)) AS x, CAST(sum(source_size) AS DOUBLE) AS total FROM s
          UNION ALL SELECT step + 1, list_transform(x, lambda e: struct_pack(source := e.source, full_ := e.full_, weight := e.weight, stopped := e.stopped OR e.full_ / e.weight <=
            (total - list_sum(list_prepend(0.0::DOUBLE, list_transform(list_filter(x, lambda f: f.stopped), lambda f: f.full_)))) / list_sum(list_transform(list_filter(x, lambda f: NOT f.stopped), lambda f: f.weight)))), total
          FROM fill WHERE step < 200 AND len(list_filter(x, lambda f: NOT f.stopped)) > 0),
        last AS (SELECT x, total FROM fill WHERE step = (SELECT max(step) FROM fill)),
        level AS (SELECT coalesce((total - list_sum(list_prepend(0.0::DOUBLE, list_transform(list_filter(x, lambda f: f.stopped), lambda f: f.full_)))) / list_sum(list_transform(list_filter(x, lambda f: NOT f.stopped), lambda f: f.weight)), 0) AS w FROM last),
        t AS (SELECT u.source AS source, CASE WHEN u.stopped THEN u.full_ ELSE u.weight * (SELECT w FROM level) END AS target FROM (SELECT unnest(x) AS u FROM last))
        SELECT doc_id, d.size, s.source_size, CAST(round(target * 1000000) AS BIGINT) AS target_1e6 FROM docs d JOIN s ON d.source IS NOT DISTINCT FROM s.source JOIN t ON t.source IS NOT DISTINCT FROM s.source""",
    "edited_texts": """SELECT doc_id, n AS n_chars, sha256(left(t, n - n // 2) || left(after, n // 2)) AS edited_sha256, CAST(coalesce(list_position(list_transform(
          list_zip(string_split(t, ''), string_split(after, '')), lambda p: p[1] IS NOT DISTINCT FROM p[2]), false) - 1, least(n, length(after))) AS BIGINT) AS agree_next FROM
        (SELECT *, length(t) AS n, coalesce(lead(t) OVER (ORDER BY doc_id DESC NULLS LAST), first_value(t) OVER (ORDER BY doc_id DESC NULLS LAST)) AS after FROM
            (SELECT doc_id, coalesce(text, '') AS t FROM documents))""",
    "op13_merkle_manifest": f"""WITH RECURSIVE leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM
          (SELECT doc_id, coalesce('=' || lang, '-') AS g, {_LEAF} AS leaf, CASE WHEN {_CRC} % 7 = 0 THEN {_TOLD} ELSE {_LEAF} END AS told FROM documents)),
        up AS (SELECT 0 AS lv, g, i, leaf AS h, n FROM leaves UNION ALL SELECT lv + 1, g, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM up WHERE n > 1 GROUP BY lv, g, i // 2, n),
        subs AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
        over_ AS (SELECT 0 AS lv, i, subroot AS h, n FROM subs UNION ALL SELECT lv + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM over_ WHERE n > 1 GROUP BY lv, i // 2, n),
        steps AS (SELECT l.g, l.i, o.lv, CASE WHEN s.h IS NULL THEN 'N' WHEN s.i < o.i THEN 'L' || s.h ELSE 'R' || s.h END AS x FROM leaves l
            JOIN up o ON o.g = l.g AND o.i = l.i >> o.lv AND o.n > 1 LEFT JOIN up s ON s.g = o.g AND s.lv = o.lv AND s.i = xor(o.i, 1)),
        low AS (SELECT g, i, list(x ORDER BY lv) AS path FROM steps GROUP BY ALL),
        high AS (SELECT b.g, b.subroot, list(CASE WHEN s.h IS NULL THEN 'N' WHEN s.i < o.i THEN 'L' || s.h ELSE 'R' || s.h END ORDER BY o.lv) FILTER (o.lv IS NOT NULL) AS path FROM subs b
            LEFT JOIN over_ o ON o.i = b.i >> o.lv AND o.n > 1 LEFT JOIN over_ s ON s.lv = o.lv AND s.i = xor(o.i, 1) GROUP BY 1, 2),
        whole AS (SELECT l.doc_id, leaf, told, subroot, (SELECT h FROM over_ WHERE n = 1) AS root, list_concat(coalesce(low.path, []), coalesce(high.path, [])) AS path FROM leaves l LEFT JOIN low USING (g, i) JOIN high USING (g))
        SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: substr(x, 2)), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM (SELECT *,
            list_reduce(list_prepend(told, path), lambda a, x: CASE x[1] WHEN 'L' THEN sha256(substr(x, 2) || a) WHEN 'R' THEN sha256(a || substr(x, 2)) ELSE sha256(a) END) AS folded_root FROM whole)""",
    "op5_embedding_dedup": """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
        link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
        reach AS (SELECT DISTINCT a AS node, a AS root FROM link UNION SELECT l.b, r.root FROM reach r JOIN link l ON l.a = r.node),
        n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY 1), c AS (SELECT node AS vec_id, min(root) AS component_id FROM reach GROUP BY 1)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
        FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)""",
}


def _query(name: str):
    def run(spark, sf_dir):
        return getattr(import_module(f"tessera.llm.{MODULES[name]}"), name)(spark, sf_dir)

    return run


QUERIES = {name: _query(name) for name in MODULES}
