"""DuckDB SQL for those queries that SQL can express; the others are tested against brute force.

Not expressible, for what they call: op2, op8 and op12 (a tokenizer), op3 and op9 (SimHash over hashes that
DuckDB lacks), op4 and op6 (learned models).
"""

from __future__ import annotations

from .decontamination import EQUAL, MASKS, OVERLAP, SPAN
from .secret_ledger import BASE_RULES, RULES
from .spelling import DELETE_EVERY, LEAST_COUNT, LEAST_LENGTH, RATIO
from .substring_dedup import K
from .url_filter import ORDER
from .url_filter import RULES as URL_RULES

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _substring_dedup() -> str:
    return f"""
WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
place AS (SELECT doc_id, words, unnest(range(len(words) - {K - 1})) AS p FROM w),
win AS (SELECT doc_id, p, md5(array_to_string(words[p + 1 : p + {K}], ' ')) AS h FROM place),
least AS (SELECT h, min(doc_id) AS least FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + {K})) AS p FROM win JOIN least USING (h) WHERE least < doc_id),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
         FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def _secret_ledger() -> str:
    found = []
    for k, r in enumerate(RULES):
        pattern = "'" + r.pattern.replace("'", "''") + "'"
        found.append(f"""
SELECT doc_id, {k} AS ord, '{r.kind}' AS kind, n, size,
       sum(before + size) OVER (PARTITION BY doc_id ORDER BY n) AS stop, part >= {r.least} AS fits
FROM (SELECT doc_id, unnest(range(len(m))) AS n, length(unnest(m)) AS size, length(unnest(g)) AS part,
             length(unnest(b[1 : len(m)])) AS before
      FROM (SELECT doc_id, regexp_extract_all(t, {pattern}) AS m, regexp_extract_all(t, {pattern}, {r.group}) AS g,
                   string_split_regex(t, {pattern}) AS b
            FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)))""")
    each = "kind || ':' || start || ':' || stop"
    counts = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)
    sums = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
    return f"""
WITH found AS ({" UNION ALL ".join(found)}),
span AS (SELECT doc_id, ord, kind, (stop - size)::BIGINT AS start, stop::BIGINT AS stop FROM found WHERE fits),
doc AS (SELECT doc_id, {sums},
               string_agg({each}, ',' ORDER BY start, ord) FILTER (ord < {len(BASE_RULES)}) AS base,
               string_agg({each}, ',' ORDER BY start, ord) AS spans
        FROM span GROUP BY doc_id)
SELECT d.doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN doc USING (doc_id)"""


def _decontamination() -> str:
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"

    def seeds(of: str, key: str) -> str:
        one = [
            f"SELECT {key}, p, {k} AS mask, concat_ws(' ', {', '.join(f'words[p + {i + 1}]' for i, c in enumerate(m) if c == '1')}) AS seed FROM at_{of}"
            for k, m in enumerate(MASKS)
        ]
        return " UNION ALL ".join(one)

    return f"""
WITH d AS (SELECT doc_id, {words} AS words FROM documents),
b AS (SELECT words, min(item_id) AS item_id FROM (SELECT item_id, {words} AS words FROM benchmark) GROUP BY words),
at_d AS (SELECT doc_id, words, unnest(range(len(words) - {SPAN - 1})) AS p FROM d),
at_b AS (SELECT item_id, words, unnest(range(len(words) - {SPAN - 1})) AS p FROM b),
seed_d AS ({seeds("d", "doc_id")}),
seed_b AS ({seeds("b", "item_id")}),
hit AS (SELECT DISTINCT doc_id, item_id, seed_d.p - seed_b.p AS shift FROM seed_d JOIN seed_b USING (mask, seed)),
pair AS (SELECT doc_id, item_id, shift, d.words AS dw, b.words AS bw, unnest(range(len(b.words))) AS i
         FROM hit JOIN d USING (doc_id) JOIN b USING (item_id)),
same AS (SELECT doc_id, item_id, shift, i, least({OVERLAP}, len(bw)) AS n, len(bw) AS items,
                CASE WHEN shift + i >= 0 AND dw[shift + i + 1] = bw[i + 1] THEN 1 ELSE 0 END AS eq FROM pair),
run AS (SELECT *, sum(eq) OVER (PARTITION BY doc_id, item_id, shift ORDER BY i) AS so_far FROM same),
ok AS (SELECT DISTINCT x.doc_id, x.item_id
       FROM run x LEFT JOIN run y ON x.doc_id = y.doc_id AND x.item_id = y.item_id AND x.shift = y.shift AND y.i = x.i - x.n
       WHERE x.i >= x.n - 1 AND x.so_far - coalesce(y.so_far, 0) >= ceil(x.n * {EQUAL})),
doc AS (SELECT doc_id, list(item_id ORDER BY item_id) AS item_ids FROM ok GROUP BY doc_id)
SELECT documents.doc_id, coalesce(len(item_ids), 0)::BIGINT AS n_items, coalesce(item_ids, []::BIGINT[]) AS item_ids,
       item_ids IS NOT NULL AS contaminated
FROM documents LEFT JOIN doc USING (doc_id)"""


def _url_filter() -> str:
    part = lambda k: rf"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', {k}), '')"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def case(value) -> str:
        rules = sorted(URL_RULES, key=lambda r: -len(r.pattern))
        return "CASE " + " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'" for r in rules
        ) + " END"

    levels = []
    for k in range(ORDER + 1):
        below = f"JOIN m{k - 1} ON m{k - 1}.gram = substring(n.gram, 2, {k})" if k else ""
        p = {c: f"p_{c}" if k else "1 / 256" for c in "ar"}
        smooth = ", ".join(
            f"CASE WHEN all_{c} > 0 THEN (n.{c} + kinds_{c} * {p[c]}) / (all_{c} + kinds_{c}) ELSE {p[c]} END::DOUBLE AS p_{c}" for c in "ar"
        )
        levels.append(f"""
c{k} AS (SELECT substring(gram, {ORDER + 1 - k}, {k + 1}) AS gram, sum(a)::DOUBLE AS a, sum(r)::DOUBLE AS r FROM counts GROUP BY ALL),
x{k} AS (SELECT substring(gram, 1, {k}) AS context, sum(a) AS all_a, sum(r) AS all_r,
                count(*) FILTER (a > 0) AS kinds_a, count(*) FILTER (r > 0) AS kinds_r FROM c{k} GROUP BY ALL),
m{k} AS MATERIALIZED (SELECT n.gram, {smooth} FROM c{k} n JOIN x{k} ON x{k}.context = substring(n.gram, 1, {k}) {below})""")
    return f"""
WITH parts AS (SELECT page_id, translate({part(1)}, '{upper}', '{lower}') AS host, {part(2)} AS path FROM pages),
judged AS (SELECT *, host || path AS url, {case(lambda r: r.pattern)} AS rule, {case(lambda r: r.verdict)} AS label FROM parts),
urls AS (SELECT url, count(*) FILTER (label = 'allow') AS a, count(*) FILTER (label = 'block') AS r FROM judged WHERE url <> '' GROUP BY url),
grams AS (SELECT url, a, r, substring(repeat(chr(2), {ORDER}) || url || chr(2), i, {ORDER + 1}) AS gram
          FROM (SELECT *, unnest(range(1, length(url) + 2)) AS i FROM urls)),
counts AS MATERIALIZED (SELECT gram, sum(a) AS a, sum(r) AS r FROM grams GROUP BY gram),{",".join(levels)},
scores AS MATERIALIZED (SELECT url, any_value(grams.a) AS a, any_value(grams.r) AS r, avg(ln(p_a) - ln(p_r)) AS score
           FROM grams JOIN m{ORDER} USING (gram) GROUP BY url),
sides AS (SELECT avg(score) FILTER (a > 0) AS ma, avg(score) FILTER (r > 0) AS mr,
                 stddev_pop(score) FILTER (a > 0) AS sa, stddev_pop(score) FILTER (r > 0) AS sr FROM scores),
cut AS (SELECT CASE WHEN sa + sr > 0 THEN (ma * sr + mr * sa) / (sa + sr) ELSE (ma + mr) / 2 END AS cut FROM sides)
SELECT page_id, host, path, rule,
       coalesce(label, CASE WHEN cut IS NULL OR coalesce(score, 0) >= cut THEN 'allow' ELSE 'block' END) AS verdict
FROM judged LEFT JOIN scores USING (url) CROSS JOIN cut"""


#: The table of the CRC-32 polynomial (reversed form), as one list; DuckDB has no crc32.
_CRC_TABLE = """(SELECT list(v ORDER BY i) AS crc_table FROM (SELECT i, list_reduce(
    [i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k : CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
) AS v FROM range(256) AS r(i)))"""


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII and Latin-1 letters as UTF-8; needs ``crc_table`` in scope."""
    code = "unicode(c)::BIGINT"
    utf8 = f"CASE WHEN {code} < 128 THEN [{code}] ELSE [192 + ({code} >> 6), 128 + ({code} & 63)] END"
    return f"""xor(4294967295, list_reduce(
    flatten(list_prepend([4294967295], list_transform(string_split({text}, ''), lambda c : {utf8}))),
    lambda x, b : xor(x >> 8, crc_table[(xor(x, b) & 255) + 1])))"""


def _spelling_variants() -> str:
    return f"""
WITH RECURSIVE crc AS {_CRC_TABLE},
run AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
grp AS (SELECT doc_id, run, count(*) AS c FROM run WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
hashed AS (SELECT run, c, {_crc32("doc_id::VARCHAR || ':' || run")} AS h FROM grp, crc),
typo AS (SELECT CASE WHEN h % {DELETE_EVERY} = 0
                THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c
         FROM hashed),
w AS (SELECT word, sum(c)::BIGINT AS n FROM typo WHERE length(word) >= {LEAST_LENGTH} GROUP BY word
      HAVING sum(c) >= {LEAST_COUNT}),
del AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM del a JOIN del b USING (i, rest) WHERE a.word <> b.word
         UNION SELECT DISTINCT w.word, w.n, del.word, del.n FROM w JOIN del ON w.word = del.rest
         UNION SELECT DISTINCT del.word, del.n, w.word, w.n FROM w JOIN del ON w.word = del.rest),
best AS (SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other,
                first(other_n ORDER BY other_n DESC, other) AS other_n FROM near GROUP BY word, n),
form AS (SELECT word, other AS form, other_n AS form_n FROM best WHERE other_n >= {RATIO} * n),
walk AS (SELECT word, form AS root, 1 AS steps FROM form
         UNION ALL SELECT walk.word, form.form, steps + 1 FROM walk JOIN form ON walk.root = form.word),
root AS (SELECT word, arg_max(root, steps) AS root FROM walk GROUP BY word)
SELECT w.word, form, coalesce(root, w.word) AS root, w.n, coalesce(n_near, 0)::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM w LEFT JOIN best USING (word) LEFT JOIN form USING (word) LEFT JOIN root USING (word)"""


def _merkle_manifest(source_levels: int = 5, top_levels: int = 3) -> str:
    """The tree level by level: up to 16^5 documents a source and 16^3 sources."""
    def digest(text: str) -> str:
        fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
        parts = (f"coalesce(octet_length(encode({x})) || ':' || {x}, '-')" for x in fields)
        return f"sha256({' || '.join(parts)})"

    def climb(name: str, first: str, group: str, levels: int) -> str:
        """CTEs name0..nameN (grp, i, d) and side CTEs with each node's siblings left and right."""
        part = f"PARTITION BY {group}" if group else ""
        by = f"{group}, " if group else ""
        out = [f"{name}0 AS ({first})"]
        for k in range(levels):
            run = f"PARTITION BY {by}i // 16 ORDER BY i"
            out.append(f"""{name}s{k} AS (SELECT *, count(*) OVER ({part}) AS n,
    coalesce(string_agg(d, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
            out.append(f"""{name}{k + 1} AS (SELECT {by}i // 16 AS i,
    CASE WHEN max(n) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE max(d) END AS d FROM {name}s{k} GROUP BY {by}i // 16)""")
        return ",\n".join(out)

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps, state = [], "f0"
    for name, levels in (("a", source_levels), ("t", top_levels)):
        for k in range(levels):
            same = f"s.source IS NOT DISTINCT FROM f.source AND s.i = f.i // {16**k}" if name == "a" else f"s.i = f.j // {16**k}"
            steps.append(f"""{state}{name}{k} AS (SELECT f.* REPLACE (f.proof || s.l || s.r AS proof,
    CASE WHEN s.n > 1 THEN sha256(s.l || f.x || s.r) ELSE f.x END AS x) FROM {state} f JOIN {name}s{k} s ON {same})""")
            state += f"{name}{k}"
    joined = ",\n".join(steps)
    return f"""
WITH crc AS {_CRC_TABLE},
leaf AS (SELECT doc_id, source, {digest("text")} AS d, {_crc32("doc_id::VARCHAR")} % 5 = 0 AS chosen,
                {digest(lower)} AS lowered FROM documents, crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, d) - 1 AS i FROM leaf),
{climb("a", "SELECT source, i, d FROM placed", "source", source_levels)},
top AS (SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS j FROM a{source_levels}),
{climb("t", "SELECT j AS i, d FROM top", "", top_levels)},
f0 AS (SELECT doc_id, placed.source, i, j, placed.d AS leaf, top.d AS subroot, '' AS proof,
              CASE WHEN chosen THEN lowered ELSE placed.d END AS x
       FROM placed JOIN top ON top.source IS NOT DISTINCT FROM placed.source),
{joined}
SELECT doc_id, leaf, subroot, t{top_levels}.d AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = t{top_levels}.d AS verified
FROM {state}, t{top_levels}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": _substring_dedup(),
        "op5_url_filter": _url_filter(),
        "op7_secret_ledger": _secret_ledger(),
        "op10_decontamination": _decontamination(),
        "op11_spelling_variants": _spelling_variants(),
        "op13_merkle_manifest": _merkle_manifest(),
    }
