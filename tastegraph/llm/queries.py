"""The registered queries of this package: ``opN_<name>(spark, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.llm.common import documents, table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.packing import pack
    return pack(documents(spark, sf_dir), vocabulary(), end_id=2, capacity=1024, keep_ids=False, keep_encoder=True)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.tokenfile import token_files
    return token_files(documents(spark, sf_dir), vocabulary(), end_id=2)


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.spotsigs import edited_likeness
    return edited_likeness(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.langid import identify
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.licenses import scan
    return scan(documents(spark, sf_dir))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.suffix import remove_repeats
    found = remove_repeats(documents(spark, sf_dir), length=400)
    removed = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]), F.lit(0))
    return found.select("doc_id", (F.octet_length("kept") + removed).cast("long").alias("n_bytes"), removed.cast("long").alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "text")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.mixing import length_quality, mix, n_words
    mixed = mix(documents(spark, sf_dir), n_words(F.col("text")), length_quality(F.col("size")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.quality import judge
    return judge(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                  "base_failed", "kept", "probability")


def op9_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.neardup import near_duplicates
    found = near_duplicates(documents(spark, sf_dir), words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: The rules of op10 (verdict, host, path).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
             ("block", "net", "/fr/")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.urls import judge
    return judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.variants import dropped_letter, variants, words
    return variants(words(documents(spark, sf_dir), least_length=7, least_count=2, change=dropped_letter), times=10)


#: The vocabulary of op12: word ends marked, lower case, white space dropped.
WORD_VOCABULARY = "word_bpe_49k.json"


def word_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(WORD_VOCABULARY)


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.bpe import decode, encode
    found = decode(encode(documents(spark, sf_dir), word_vocabulary()), word_vocabulary())
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tastegraph.llm.conversations import damage, report
    conversations = table(spark, sf_dir, "conversations")
    return report(conversations, damage(conversations))


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_spotsigs, op3_language_id, op4_license_scan, op5_suffix_dedup, op6_token_files,
                                   op7_source_mix, op8_quality_rules, op9_minhash_neardup, op10_url_filter, op11_spelling_variants, op12_bpe_round_trip,
                                   op13_conversation_repair)}

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEARDUP_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.replace('text', _LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id AS d, doc_id AS m FROM documents UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.d WHERE r.m < e.b)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m AS component_id, doc_id = m AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT d, min(m) AS m FROM r GROUP BY d) g ON g.d = doc_id"""

_MIX_SQL = f"""
WITH b AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
             -ln((('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) AS x
           FROM documents),
k AS (SELECT *, CASE WHEN size > 0 THEN x / (size / (size + 50.0::DOUBLE)) END AS key FROM b),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight, source_size * 3 AS cap FROM s),
r AS (SELECT *, cap::DOUBLE / weight AS ratio FROM w),
u AS (SELECT *, (sum(source_size) OVER () - (sum(cap) OVER o - cap))::DOUBLE / sum(weight) OVER (ORDER BY ratio, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit FROM r
      WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT arg_min(unit, ratio) AS unit FROM u WHERE ratio >= unit),
t AS (SELECT source, source_size, CASE WHEN ratio < l.unit THEN cap::DOUBLE ELSE l.unit * weight END AS target FROM u, l),
e AS (SELECT k.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, target - epochs * source_size AS rest, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key NULLS LAST, doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE size * (epochs + CASE WHEN before + size <= rest
         OR (before < rest AND before + size - rest < rest - before) THEN 1 ELSE 0 END) END::BIGINT AS taken FROM p"""



def _license_sql() -> str:
    from tastegraph.llm.licenses import LEAST, NOTICES, bigrams_of, size_bounds
    rows = []
    for name, text in NOTICES:
        grams = bigrams_of(text)
        rows.append(f"('{name}', {grams}, {', '.join(f'{x!r}::DOUBLE' for x in size_bounds(len(grams), LEAST))})")
    return f"""
WITH t(license, g, lo, hi) AS (VALUES {', '.join(rows)}),
d AS (SELECT doc_id, unnest(list_concat(list_transform(string_split(text, chr(10)), lambda x: {{'line': true, 'part': x}}),
        [{{'line': false, 'part': text}}])) AS p FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, p.line AS line, string_split(trim(regexp_replace(translate(p.part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM d),
g AS (SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w),
s AS (SELECT doc_id, line, license, (2 * len(list_intersect(g.g, t.g)))::DOUBLE / (len(g.g) + len(t.g)) AS dice FROM g JOIN t ON len(g.g) BETWEEN lo AND hi),
m AS (SELECT doc_id, arg_max(license, (dice, -ascii(license))) AS license, max(dice) AS dice FROM s WHERE dice >= {LEAST} GROUP BY doc_id),
h AS (SELECT doc_id, greatest(1, sum(n)) AS n FROM (SELECT g.doc_id, 1 AS n FROM (SELECT *, row_number() OVER () AS k FROM g WHERE line) g
        WHERE EXISTS (SELECT 1 FROM t WHERE len(g.g) BETWEEN lo AND hi AND (2 * len(list_intersect(g.g, t.g)))::DOUBLE / (len(g.g) + len(t.g)) >= {LEAST}))
        GROUP BY doc_id)
SELECT doc_id, license, coalesce(dice, 0.0)::DOUBLE AS dice, CASE WHEN license IS NULL THEN 0 ELSE coalesce(n, 1) END::BIGINT AS n_notices
FROM documents LEFT JOIN m USING (doc_id) LEFT JOIN h USING (doc_id)"""


_CRC_TABLE = """(SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table)"""


def _crc(text: str) -> str:
    """crc32 of the UTF-8 text, with the column ``crc_table`` at hand."""
    code = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {code}), "
            "lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)")


_VARIANTS_SQL = f"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\u00C0-\u00FF]+')) AS w FROM documents),
h AS (SELECT w, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || w")} AS h FROM r, {_CRC_TABLE} WHERE length(w) >= 7),
v AS (SELECT word, count(*)::BIGINT AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2)
        ELSE w END AS word FROM h) WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
k AS (SELECT word, n, unnest(list_transform(range(1, length(word) + 1), lambda i: {{'at': i, 'rest': substr(word, 1, i - 1) || substr(word, i + 1)}})) AS k FROM v),
p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM k a JOIN k b ON a.k = b.k AND a.word <> b.word
      UNION SELECT k.word, k.n, v.word, v.n FROM k JOIN v ON v.word = k.k.rest UNION SELECT v.word, v.n, k.word, k.n FROM k JOIN v ON v.word = k.k.rest),
f AS (SELECT v.word, v.n, count(near) AS n_near, min(struct_pack(less := -near_n, near := near)) FILTER (near IS NOT NULL) AS best
      FROM v LEFT JOIN p ON p.word = v.word GROUP BY v.word, v.n),
g AS (SELECT word, n, n_near, CASE WHEN -best.less >= 10 * n THEN best.near END AS form, CASE WHEN -best.less >= 10 * n THEN -best.less END AS form_n FROM f),
t AS (SELECT word, word AS goal, 0 AS d FROM g UNION ALL SELECT t.word, g.form, d + 1 FROM t JOIN g ON g.word = t.goal WHERE g.form IS NOT NULL)
SELECT g.word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM g JOIN (SELECT word, arg_max(goal, d) AS root FROM t GROUP BY word) x ON x.word = g.word"""


_TURN_ORDER = "turn NULLS FIRST, role, substr(text, 1, 32), sha256(text)"
_REPAIR_SQL = f"""
WITH RECURSIVE q AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc(
    "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS code FROM conversations, {_CRC_TABLE}),
d AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
      FROM q WHERE code <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY {_TURN_ORDER}, copy) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
        dense_rank() OVER (ORDER BY conv_id) AS c, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY {_TURN_ORDER}, copy) AS k,
        lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY {_TURN_ORDER}, copy) || substr(role, 1, 1) AS pair FROM d),
b AS (SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS whole FROM o),
f AS (SELECT *, NOT blank AND k > 1 AS duplicate, NOT blank AND k = 1 AND NOT whole AS truncated, substr(role, 1, 1) AS initial FROM b),
t AS (SELECT DISTINCT c, n AS i, [{{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}}, {{'cost': 6, 'audit': 'II', 'lines': ['user:', 'assistant:']}},
        {{'cost': 3, 'audit': 'I', 'lines': ['assistant:']}}, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}}] AS v FROM f
      UNION ALL
      SELECT c, i, list_transform([0, 1, 2, 3], lambda s: list_min([x[s + 1], {{'cost': 3 + x[nx[s + 1]].cost, 'audit': 'I' || x[nx[s + 1]].audit,
          'lines': list_prepend(nm[s + 1] || ':', x[nx[s + 1]].lines)}}])) AS v
      FROM (SELECT c, i, nx, nm, list_transform([0, 1, 2, 3], lambda s: list_min([w[s + 1], {{'cost': 3 + w[nx[s + 1]].cost, 'audit': 'I' || w[nx[s + 1]].audit,
          'lines': list_prepend(nm[s + 1] || ':', w[nx[s + 1]].lines)}}])) AS x
      FROM (SELECT f.c, f.i - 1 AS i, nx, nm, list_transform([0, 1, 2, 3], lambda s: list_min(list_filter([
          {{'cost': 4 + v[s + 1].cost, 'audit': 'D' || v[s + 1].audit, 'lines': v[s + 1].lines}},
          CASE WHEN NOT (blank OR duplicate) THEN {{'cost': 3 + 3 * truncated::INT + v[nx[s + 1]].cost, 'audit': 'R' || v[nx[s + 1]].audit,
            'lines': list_prepend(nm[s + 1] || ':' || text, v[nx[s + 1]].lines)}} END,
          CASE WHEN NOT (blank OR duplicate) AND initial = substr(nm[s + 1], 1, 1) THEN {{'cost': 3 * truncated::INT + v[nx[s + 1]].cost,
            'audit': 'K' || v[nx[s + 1]].audit, 'lines': list_prepend(role || ':' || text, v[nx[s + 1]].lines)}} END,
          CASE WHEN NOT (blank OR duplicate) AND s = 0 AND initial = 's' THEN {{'cost': 3 * truncated::INT + v[2].cost, 'audit': 'K' || v[2].audit,
            'lines': list_prepend(role || ':' || text, v[2].lines)}} END], lambda y: y IS NOT NULL))) AS w
      FROM t JOIN f ON f.c = t.c AND f.i = t.i, (SELECT [3, 3, 4, 3] AS nx, ['user', 'user', 'assistant', 'user'] AS nm)))),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank, sum(duplicate::INT) AS duplicate,
        sum(truncated::INT) AS truncated, sum((pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au'))::INT) AS illegal, any_value(c) AS c FROM f GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v[1].cost, 0)::BIGINT AS cost,
  coalesce(v[1].audit, '') AS audit, sha256(coalesce(array_to_string(v[1].lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN t ON t.c = g.c AND t.i = 0"""


ORACLE: dict[str, str] = {"op4_license_scan": _license_sql(), "op7_source_mix": _MIX_SQL, "op9_minhash_neardup": _NEARDUP_SQL,
                          "op11_spelling_variants": _VARIANTS_SQL, "op13_conversation_repair": _REPAIR_SQL}
