"""Queries of the numbered operators over the test tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    chat_format, decontamination, exact_dedup, heap_kmeans, html_text, license_scan, line_dedup, merkle, mixing, pitman_yor,
    simhash_dedup, toxicity, url_filter,
)
from millrace.plans.registry import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return fn

    return wrap


ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op1_exact_dedup",
    f"""
    WITH t AS (SELECT doc_id, sha256({ASCII_LOWER}) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM t WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op1(t: Tables) -> DataFrame:
    return exact_dedup.exact_groups(t.documents, keep="max")


def remainder(key: str, by: int):
    """crc32 of the key as text, modulo ``by``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % by


@query("op2_pitman_yor")
def op2(t: Tables) -> DataFrame:
    held_out = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    out = pitman_yor.score_texts(t.documents, ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


@query("op3_toxicity")
def op3(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text")
    model = toxicity.fit(docs, t.labels, learn=remainder("doc_id", 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SPAM_NAMES = ("ads-track", "casino-win", "cheap-pills", "free-bets")
SPAM_HOSTS = tuple(f"{name}.example.{top}" for name in SPAM_NAMES for top in ("com", "net", "org"))


@query(
    "op4_url_filter",
    f"""
    WITH a AS (
      SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), b AS (
      SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
      FROM a
    ), c AS (
      SELECT *, CASE
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
      FROM b
    )
    SELECT page_id, host, path, rule, CASE
      WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
      WHEN regexp_matches(host, '(^|[.])({'|'.join(SPAM_NAMES)})[.]example[.](com|net|org)$') THEN 'block' ELSE 'allow' END AS verdict
    FROM c
    """,
)
def op4(t: Tables) -> DataFrame:
    pages = t.pages.select("page_id", "url")
    return url_filter.filter_urls(pages, RULES, SPAM_HOSTS).select("page_id", "host", "path", "rule", "verdict")


#: a conversation beside the table's own, whose texts hold the template's control strings
PLANTED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
_ESCAPED = r"""regexp_replace(regexp_replace({0}, '(\\*)({1})', '\1\1\\\2', 'g'), '(\\*)$', '\1\1')"""


@query(
    "op5_chat_format",
    rf"""
    WITH r AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ), s AS (
      SELECT *, '### ' || {_ESCAPED.format("role", "###|</turn>|:")} || ': ' || {_ESCAPED.format("text", "###|</turn>")} || '</turn>' || chr(10) AS segment FROM r
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(segment)) AS BIGINT) AS formatted_chars
    FROM s GROUP BY conv_id
    """,
)
def op5(t: Tables) -> DataFrame:
    planted = t.spark.createDataFrame(PLANTED, "conv_id bigint, turn bigint, role string, text string")
    return chat_format.format_chats(t.conversations.select("conv_id", "turn", "role", "text").unionByName(planted))


MIX_SQL = f"""
    WITH RECURSIVE s AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents
    ), per AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight
      FROM s GROUP BY source
    ), fill(round, level) AS (
      SELECT 0, (SELECT 1.5::DOUBLE * sum(source_size) / sum(weight) FROM per)
      UNION ALL
      SELECT round + 1, (SELECT (1.5::DOUBLE * sum(source_size) - sum(CASE WHEN 2.0::DOUBLE * source_size / weight <= level
                                   THEN 2.0::DOUBLE * source_size ELSE 0.0::DOUBLE END))
                                / sum(CASE WHEN 2.0::DOUBLE * source_size / weight <= level THEN 0 ELSE weight END) FROM per)
      FROM fill WHERE round < (SELECT count(*) FROM per)
    ), goal AS (
      SELECT per.*, CASE WHEN 2.0::DOUBLE * source_size / weight <= level THEN 2.0::DOUBLE * source_size ELSE level * weight END AS target
      FROM per, (SELECT max(level) AS level FROM fill)
    ), r AS (
      SELECT doc_id, size, source_size, target, target / source_size AS rate,
             CAST(('0x' || substr(md5('mix:' || doc_id), 1, {mixing.DIGITS})) AS UBIGINT)::DOUBLE / {16**mixing.DIGITS}::DOUBLE AS u
      FROM s JOIN goal ON s.source IS NOT DISTINCT FROM goal.source
    )
    SELECT doc_id, size, source_size, target,
           size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
    FROM r
    """


@query("op6_mixing", MIX_SQL)
def op6(t: Tables) -> DataFrame:
    sized = mixing.stable(t.documents.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    counts = mixing.mix_counts(sized, mixing.stable(mixing.source_targets(sized)))
    return counts.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op7_html_text")
def op7(t: Tables) -> DataFrame:
    return html_text.extract_text(t.pages, carry=["url"])


@query(
    "op8_decontamination",
    f"""
    WITH w AS (
      SELECT doc_id, regexp_extract_all({ASCII_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
    ), b AS (
      SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({ASCII_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark
    ), bw AS (
      SELECT DISTINCT item, least(len(words), 10) AS width, array_to_string(words[pos:pos + least(len(words), 10) - 1], ' ') AS phrase
      FROM (SELECT *, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS pos FROM b WHERE len(words) > 0)
    ), dw AS (
      SELECT doc_id, pos, width, array_to_string(words[pos:pos + width - 1], ' ') AS phrase
      FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS pos
            FROM w, (SELECT DISTINCT width FROM bw) WHERE len(words) >= width)
    ), found AS (SELECT DISTINCT doc_id, pos, dw.width, phrase, item FROM dw JOIN bw USING (phrase, width)),
    hit AS (SELECT doc_id, count(DISTINCT spot) AS n_hit
            FROM (SELECT doc_id, unnest(range(pos, pos + width)) AS spot FROM found) GROUP BY doc_id),
    held AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
             FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
    """,
)
def op8(t: Tables) -> DataFrame:
    out = decontamination.decontaminate(t.documents, t.benchmark)
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@query("op9_simhash_dedup")
def op9(t: Tables) -> DataFrame:
    out = simhash_dedup.near_groups(t.documents)
    return out.select("doc_id", simhash_dedup.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query("op10_license_scan")
def op10(t: Tables) -> DataFrame:
    return license_scan.scan_licenses(t.documents).drop("spans")


CLUSTERS, ROUNDS, WIDTH, SCALE = 40, 5, 64, 256


def _sql_kmeans() -> str:
    far = "CAST(list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i]))) AS BIGINT)"
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT row, min({far} * 1000 + c) AS best FROM v, c{r} GROUP BY row)")
        if r < ROUNDS:
            steps.append(f"""s{r} AS (SELECT best % 1000 AS c, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
                             FROM a{r} JOIN v USING (row), (SELECT unnest(range(1, 65)) AS i) GROUP BY ALL)""")
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c, coalesce(moved, m) AS m FROM c{r} LEFT JOIN
                             (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS moved FROM s{r} GROUP BY c) USING (c))""")
    return f"""
    WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
    ), c0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY draw, v) - 1 AS c, v AS m FROM (SELECT sha256('2:' || vec_id) AS draw, v FROM v ORDER BY draw, v LIMIT {CLUSTERS})
    ), {", ".join(steps)}
    SELECT vec_id, CAST(best % 1000 AS INTEGER) AS cluster, best // 1000 AS distance,
           CAST(sum(best // 1000) OVER (PARTITION BY best % 1000) AS BIGINT) AS cluster_inertia,
           CAST(sum(best // 1000) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM a{ROUNDS} JOIN v USING (row) JOIN c{ROUNDS} ON c = best % 1000
    """


@query("op11_heap_kmeans", _sql_kmeans())
def op11(t: Tables) -> DataFrame:
    out = heap_kmeans.cluster_vectors(t.embeddings, CLUSTERS, ROUNDS, WIDTH, SCALE, seed="2:")
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256).alias("centroid_sha256")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest)


#: unsigned crc32 of a decimal number's text, bit by bit
SQL_CRC32 = """xor(4294967295::BIGINT, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _sql_leaf(n_chars: str) -> str:
    texts = [f"CAST({n_chars if f == 'n_chars' else f} AS VARCHAR)" for f in LEAF_FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({t})::VARCHAR || ':' || {t}, '-')" for t in texts) + ")"


MERKLE_SQL = f"""
    WITH RECURSIVE leaf AS (
      SELECT doc_id, lang, {_sql_leaf("n_chars")} AS leaf,
             {_sql_leaf(f"CASE WHEN {SQL_CRC32} % 7 = 0 THEN n_chars + 1 ELSE n_chars END")} AS again,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
      FROM documents
    ), tree(lang, lvl, idx, n, d) AS (
      SELECT lang, 0, pos, n, leaf FROM leaf
      UNION ALL
      SELECT lang, max(lvl) + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(d, '' ORDER BY idx)) FROM tree WHERE n > 1 GROUP BY lang, idx // 2
    ), sub AS (
      SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS gpos, count(*) OVER () AS gn FROM tree WHERE n = 1
    ), top(lvl, idx, n, d) AS (
      SELECT 0, gpos, gn, subroot FROM sub
      UNION ALL
      SELECT max(lvl) + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(d, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY idx // 2
    ), every AS (
      SELECT l.doc_id, t.lvl, l.pos >> t.lvl AS at, t.d AS sibling FROM leaf l JOIN tree t
        ON l.lang IS NOT DISTINCT FROM t.lang AND t.idx = xor(l.pos >> t.lvl, 1)
      UNION ALL
      SELECT l.doc_id, 1000 + t.lvl, s.gpos >> t.lvl, t.d FROM leaf l JOIN sub s ON l.lang IS NOT DISTINCT FROM s.lang
        JOIN top t ON t.idx = xor(s.gpos >> t.lvl, 1)
    ), proof AS (
      SELECT doc_id, sha256(string_agg(sibling, '' ORDER BY lvl)) AS proof_sha256 FROM every GROUP BY doc_id
    ), step(doc_id, lvl, pos, n, gpos, gn, d) AS (
      SELECT l.doc_id, 0, l.pos, l.n, s.gpos, s.gn, l.again FROM leaf l JOIN sub s ON l.lang IS NOT DISTINCT FROM s.lang
      UNION ALL
      SELECT * FROM (
        SELECT f.doc_id, CASE WHEN n > 1 THEN f.lvl + 1 WHEN f.lvl < 1000 THEN 1000 ELSE f.lvl + 1 END,
               CASE WHEN n > 1 THEN pos // 2 ELSE gpos END, CASE WHEN n > 1 THEN (n + 1) // 2 ELSE gn END, gpos,
               CASE WHEN n = 1 THEN 1 ELSE gn END,
               CASE WHEN n = 1 THEN d WHEN e.sibling IS NULL THEN sha256(d) WHEN pos % 2 = 1 THEN sha256(e.sibling || d) ELSE sha256(d || e.sibling) END
        FROM step f LEFT JOIN every e ON f.doc_id = e.doc_id AND f.lvl = e.lvl
        WHERE n > 1 OR (f.lvl < 1000 AND gn > 1))
    )
    SELECT l.doc_id, l.leaf, s.subroot, (SELECT d FROM top WHERE n = 1) AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
           f.d AS folded_root, f.d = (SELECT d FROM top WHERE n = 1) AS verified
    FROM leaf l JOIN sub s ON l.lang IS NOT DISTINCT FROM s.lang LEFT JOIN proof p ON l.doc_id = p.doc_id
    JOIN (SELECT doc_id, arg_max(d, lvl) AS d FROM step GROUP BY doc_id) f ON l.doc_id = f.doc_id
    """


@query("op12_merkle_manifest", MERKLE_SQL)
def op12(t: Tables) -> DataFrame:
    touched = F.coalesce(remainder("doc_id", 7) == 0, F.lit(False))
    docs = t.documents.select(*LEAF_FIELDS, (F.col("n_chars") + touched.cast("int")).alias("n_chars_again"))
    again = merkle.leaf_digest([f"{f}_again" if f == "n_chars" else f for f in LEAF_FIELDS])
    rows = merkle.verify(merkle.manifest(docs, LEAF_FIELDS, again=again))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest().alias("proof_sha256"), "folded_root", "verified")


@query(
    "op13_line_dedup",
    """
    WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (
      SELECT doc_id, ord, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS ord FROM t)
    ), k AS (
      SELECT key, max(doc_id) AS top FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (top <> doc_id) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY ord) FILTER (top IS NULL OR top = doc_id), '')) AS kept_sha256
    FROM l LEFT JOIN k USING (key) GROUP BY doc_id
    """,
)
def op13(t: Tables) -> DataFrame:
    index = line_dedup.insert(line_dedup.new_index(t.spark, min_docs=3, min_chars=20), t.documents)
    out = line_dedup.clean(index, t.documents)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
