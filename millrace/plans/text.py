"""X: text mining, sentiment and topics."""

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import regression as G
from millrace.operators import relational as R
from millrace.operators import reshape
from millrace.operators import text as X
from millrace.operators import topics as TP
from millrace.operators import windows as W
from millrace.plans.ordering import unit_sql
from millrace.plans.registry import query
from millrace.session import scratch_path, stable
from millrace.sources import files

WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}'']+')"
TOKENS_SQL = f"SELECT doc_id, lang, source, unnest({WORDS_SQL}) AS word FROM documents"
# a few frequent words of the four corpus languages
STOP = {
    "en": ["the", "and", "of", "to", "in", "a", "is", "that"],
    "de": ["der", "die", "das", "und", "in", "zu", "ist", "ein"],
    "fr": ["le", "la", "les", "et", "de", "un", "une", "que"],
    "es": ["el", "la", "los", "y", "de", "un", "una", "que"],
}
STOP_SQL = "(VALUES " + ", ".join(f"('{k}', '{w}')" for k, ws in STOP.items() for w in ws) + ") AS stop(lang, word)"
# the sentiment list is taken from the second corpus: even length counts as positive
LEXICON_SQL = f"""SELECT DISTINCT word, CASE WHEN length(word) % 2 = 0 THEN 'positive' ELSE 'negative' END AS sentiment
    FROM (SELECT unnest({WORDS_SQL}) AS word FROM benchmark)"""


def _docs(t):
    return t.documents.select("doc_id", "lang", "source", "text")


def _tokens(t):
    return X.tokenize(_docs(t), "text")


def _stop(t):
    return t.spark.createDataFrame([(k, w) for k, ws in STOP.items() for w in ws], "lang string, word string")


def _lexicon(t):
    w = X.tokenize(t.benchmark.select("text"), "text").distinct()
    return w.withColumn("sentiment", F.when(F.length("word") % 2 == 0, "positive").otherwise("negative"))


@query("X01_words", f"SELECT doc_id, word, count(*) AS n FROM ({TOKENS_SQL}) GROUP BY 1, 2")
def x01(t):
    return R.count_by(_tokens(t), ["doc_id", "word"])


@query(
    "X01_words_positions",
    f"""SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, word FROM (SELECT conv_id, turn, unnest({WORDS_SQL}) AS word,
    unnest(range(0, len({WORDS_SQL}))) AS pos FROM conversations)""",
)
def x01_positions(t):
    return X.tokenize(t.conversations.select("conv_id", "turn", "text"), "text", position="pos")


@query(
    "X02_ngrams",
    f"""SELECT word, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS word
    FROM (SELECT {WORDS_SQL} AS w FROM documents)) GROUP BY 1""",
)
def x02(t):
    return R.count_by(X.tokenize(t.documents.select("text"), "text", "ngrams", n=2), ["word"])


@query(
    "X02_characters",
    r"SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]')) AS word FROM documents) GROUP BY 1, 2",
)
def x02_characters(t):
    return R.count_by(X.tokenize(t.documents.select("lang", "text"), "text", "characters"), ["lang", "word"])


@query(
    "X02_paragraphs",
    r"""SELECT doc_id, word FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\n\s*\n')) AS word FROM documents) WHERE word <> ''""",
)
def x02_paragraphs(t):
    return X.tokenize(t.documents.select("doc_id", "text"), "text", "paragraphs")


@query(
    "X03_sentences",
    r"""SELECT doc_id, sentence FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS sentence
    FROM documents) WHERE sentence <> ''""",
)
def x03(t):
    return X.tokenize(t.documents.select("doc_id", "text"), "text", "sentences", name="sentence")


@query(
    "X04_regex_sections",
    r"""SELECT doc_id, CAST(pos AS INTEGER) AS pos, section FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[.!?]+\n')) AS section,
    unnest(range(0, len(regexp_split_to_array(text, '[.!?]+\n')))) AS pos FROM documents) WHERE section <> ''""",
)
def x04(t):
    return X.tokenize(t.documents.select("doc_id", "text"), "text", "regex", r"[.!?]+\n", name="section", position="pos")


@query(
    "X05_stop_words",
    f"""SELECT lang, word, count(*) AS n FROM ({TOKENS_SQL}) w WHERE NOT EXISTS
    (SELECT 1 FROM {STOP_SQL} WHERE stop.lang = w.lang AND stop.word = w.word) GROUP BY 1, 2""",
)
def x05(t):
    # words are counted before they meet a list, so a common word is a row per task
    return X.remove_stop_words(R.count_by(_tokens(t), ["lang", "word"]), _stop(t), ["lang", "word"])


@query("X05_default_stop_words")
def x05_default(t):
    lists = X.stop_words(t.spark, {"en": "english", "de": "german", "fr": "french", "es": "spanish"}, ["lorem"])
    return X.remove_stop_words(R.count_by(_tokens(t), ["lang", "word"]), lists, ["lang", "word"])


@query("X06_word_ranking", f"SELECT word, count(*) AS n FROM ({TOKENS_SQL}) GROUP BY 1 HAVING count(*) > 600 ORDER BY n DESC, word")
def x06(t):
    return R.count_by(_tokens(t), ["word"]).where("n > 600").orderBy(F.desc("n"), "word")


SHARES_SQL = f"""WITH c AS (SELECT lang, word, count(*) AS n FROM ({TOKENS_SQL}) GROUP BY 1, 2),
s AS (SELECT lang, word, n / sum(n) OVER (PARTITION BY lang) AS share FROM c),
w AS (SELECT word, max(share) FILTER (lang = 'en') AS en, max(share) FILTER (lang = 'de') AS de,
    max(share) FILTER (lang = 'fr') AS fr, max(share) FILTER (lang = 'es') AS es FROM s GROUP BY 1)
"""


@query(
    "X07_corpus_comparison",
    SHARES_SQL + " UNION ALL ".join(
        f"SELECT word, round(en, 10) AS base, '{g}' AS author, round({g}, 10) AS share FROM w WHERE {g} IS NOT NULL" for g in ("de", "fr", "es")
    ),
)
def x07(t):
    wide = reshape.spread(X.shares(_tokens(t), "lang"), ["word"], "lang", "share", ["en", "de", "fr", "es"])
    long = reshape.gather(wide.withColumnRenamed("en", "base"), ["word", "base"], ["de", "fr", "es"], "author", "share", drop_null=True)
    return long.select("word", F.round("base", 10).alias("base"), "author", F.round("share", 10).alias("share"))


@query(
    "X08_share_correlation",
    SHARES_SQL + """SELECT n, round(r, 8) AS r, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t FROM
    (SELECT count(*) AS n, corr(fr, es) AS r FROM w WHERE fr IS NOT NULL AND es IS NOT NULL)""",
)
def x08(t):
    wide = reshape.spread(X.shares(_tokens(t), "lang"), ["word"], "lang", "share", ["fr", "es"])
    return G.correlation_test(wide, "fr", "es").select("n", F.round("r", 8).alias("r"), F.round("t", 6).alias("t"))


@query(
    "X09_lexicon_words",
    f"""SELECT word, count(*) AS n FROM ({TOKENS_SQL}) JOIN ({LEXICON_SQL}) USING (word)
    WHERE source = 'src1' AND sentiment = 'positive' GROUP BY 1""",
)
def x09(t):
    positive = _lexicon(t).where("sentiment = 'positive'").select("word")
    return R.count_by(_tokens(t).where("source = 'src1'"), ["word"]).join(positive, "word")


@query(
    "X10_block_sentiment",
    f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents),
    k AS (SELECT doc_id, line_no // 8 AS block, unnest({WORDS_SQL}) AS word FROM l)
    SELECT doc_id, block, count(*) FILTER (sentiment = 'negative') AS negative, count(*) FILTER (sentiment = 'positive') AS positive,
    count(*) FILTER (sentiment = 'positive') - count(*) FILTER (sentiment = 'negative') AS sentiment
    FROM k JOIN ({LEXICON_SQL}) x USING (word) GROUP BY 1, 2""",
)
def x10(t):
    rows = X.lines(t.documents.select("doc_id", "text"), "text", name="text")
    return X.block_sentiment(X.tokenize(rows, "text"), _lexicon(t), ["doc_id"], "line_no", 8)


@query(
    "X10_block_sentiment_80",
    f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents),
    k AS (SELECT doc_id, line_no // 80 AS block, unnest({WORDS_SQL}) AS word FROM l)
    SELECT doc_id, block, count(*) FILTER (sentiment = 'negative') AS negative, count(*) FILTER (sentiment = 'positive') AS positive,
    count(*) FILTER (sentiment = 'positive') - count(*) FILTER (sentiment = 'negative') AS sentiment
    FROM k JOIN ({LEXICON_SQL}) x USING (word) GROUP BY 1, 2""",
)
def x10_80(t):
    rows = X.lines(t.documents.select("doc_id", "text"), "text", name="text")
    return X.block_sentiment(X.tokenize(rows, "text"), _lexicon(t), ["doc_id"], "line_no", 80)


@query(
    "X11_top_words_per_class",
    f"""SELECT sentiment, word, n FROM (SELECT sentiment, word, n, rank() OVER (PARTITION BY sentiment ORDER BY n DESC) AS r FROM
    (SELECT sentiment, word, count(*) AS n FROM ({TOKENS_SQL}) JOIN ({LEXICON_SQL}) USING (word) GROUP BY 1, 2)) WHERE r <= 10""",
)
def x11(t):
    counts = R.count_by(_tokens(t), ["word"]).join(_lexicon(t).groupBy("word", "sentiment").agg(F.count(F.lit(1)).alias("times")), "word")
    counts = counts.select("sentiment", "word", (F.col("n") * F.col("times")).alias("n"))
    return W.top_n(counts, ["sentiment"], [F.desc("n")], 10).drop("rank")


@query(
    "X12_scored_lexicon",
    f"""SELECT doc_id, CAST(sum(score) AS BIGINT) AS score FROM ({TOKENS_SQL}) JOIN
    (SELECT word, length(word) % 11 - 5 AS score FROM ({LEXICON_SQL})) USING (word) GROUP BY 1""",
)
def x12(t):
    scores = _lexicon(t).select("word", (F.length("word") % 11 - 5).alias("score"))
    held = R.count_by(_tokens(t), ["doc_id", "word"]).join(scores, "word")
    return held.groupBy("doc_id").agg(F.sum(F.col("n") * F.col("score")).alias("score"))


@query(
    "X13_most_negative_chapters",
    f"""WITH k AS ({TOKENS_SQL}), a AS (SELECT source, doc_id, count(*) AS words FROM k GROUP BY 1, 2),
    b AS (SELECT source, doc_id, count(*) AS negative FROM k WHERE word IN (SELECT word FROM ({LEXICON_SQL}) WHERE sentiment = 'negative') GROUP BY 1, 2)
    SELECT source, doc_id, words, negative, round(ratio, 10) AS ratio FROM (
    SELECT a.source, a.doc_id, words, negative, negative / words AS ratio, rank() OVER (PARTITION BY a.source ORDER BY negative / words DESC) AS r
    FROM a JOIN b ON a.source = b.source AND a.doc_id = b.doc_id WHERE a.doc_id <> 0) WHERE r <= 3""",
)
def x13(t):
    tokens, keys = _tokens(t), ["source", "doc_id"]
    listed = _lexicon(t).where("sentiment = 'negative'").select("word").distinct().withColumn("listed", F.lit(True))
    counts = R.count_by(tokens, [*keys, "word"]).join(listed, "word", "left").groupBy(*keys)
    both = counts.agg(F.sum("n").alias("words"), F.sum(F.when(F.col("listed"), F.col("n"))).alias("negative"))
    both = both.where("negative is not null and doc_id <> 0")
    top = W.top_n(both.withColumn("ratio", F.col("negative") / F.col("words")), ["source"], [F.desc("ratio")], 3)
    return top.drop("rank").withColumn("ratio", F.round("ratio", 10))


@query(
    "X14_cleaning",
    r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(text, 'https?://[^ \t\r\n]*', '', 'g')),
    '[^\x00-\x7F]', '', 'g'), '\b(and|don''t|the)\b', ' ', 'g'), '[!-/:-@\[-`{-~]', '', 'g'), '[0-9]+', '', 'g'), '[ \t\r\n\f]+', ' ', 'g')) AS text FROM documents""",
)
def x14(t):
    return t.documents.select("doc_id", X.clean("text", ["the", "and", "don't"]).alias("text"))


@query(
    "X15_retweet_removal",
    r"SELECT conv_id, turn FROM conversations WHERE role <> 'system' AND NOT regexp_matches(text, '^(RT|MT)\b')",
)
def x15(t):
    native = F.col("role") == "system"
    return t.conversations.where(~native & ~X.is_retweet("text")).select("conv_id", "turn")


MARKED_SQL = """SELECT conv_id, turn, CASE turn % 4 WHEN 1 THEN 'RT @a: ' WHEN 2 THEN 'MT ' WHEN 3 THEN 'RTs ' ELSE '' END || text AS text
    FROM conversations"""


@query("X15_retweets_marked", rf"SELECT conv_id, turn FROM ({MARKED_SQL}) WHERE NOT regexp_matches(text, '^(RT|MT)\b')")
def x15_marked(t):
    mark = F.element_at(F.array(*[F.lit(x) for x in ("", "RT @a: ", "MT ", "RTs ")]), (F.col("turn") % 4 + 1).cast("int"))
    marked = t.conversations.withColumn("text", F.concat(mark, "text"))
    return marked.where(~X.is_retweet("text")).select("conv_id", "turn")


@query(
    "X16_source_filter",
    """SELECT page_id, language FROM (SELECT page_id, regexp_extract(html, '<html lang="(.*?)"', 1) AS language FROM pages) WHERE language IN ('en', 'es')""",
)
def x16(t):
    out = t.pages.select("page_id", S.extract_first("html", '<html lang="(.*?)"', 1).alias("language"))
    return out.where(F.col("language").isin("en", "es"))


DTM_SQL = f"SELECT doc_id, word AS term, count(*) AS n FROM ({TOKENS_SQL}) WHERE length(word) >= 3 GROUP BY 1, 2"


def _dtm(t):
    return X.term_counts(X.tokenize(t.documents.select("doc_id", "text"), "text"), "doc_id")


@query("X17_document_term_matrix", DTM_SQL)
def x17(t):
    return _dtm(t)


@query("S32_save_load_dtm", DTM_SQL)
def s32(t):
    return files.read_parquet(t.spark, files.write_parquet(_dtm(t), scratch_path(t.spark, "dtm")))


@query("X18_frequent_terms", f"SELECT term, CAST(sum(n) AS BIGINT) AS n FROM ({DTM_SQL}) GROUP BY 1 HAVING sum(n) >= 150")
def x18(t):
    return X.term_totals(_dtm(t)).where("n >= 150")


@query("X19_top_terms", f"SELECT term, CAST(sum(n) AS BIGINT) AS n FROM ({DTM_SQL}) GROUP BY 1 ORDER BY n DESC, term LIMIT 100")
def x19(t):
    return X.term_totals(_dtm(t)).orderBy(F.desc("n"), "term").limit(100)


@query(
    "X20_term_associations",
    f"""WITH d AS ({DTM_SQL}), z AS (SELECT count(*)::DOUBLE AS docs FROM documents),
    p AS (SELECT term FROM d GROUP BY 1 ORDER BY sum(n) DESC, term LIMIT 1),
    m AS (SELECT doc_id, n AS k FROM d WHERE term = (SELECT term FROM p)),
    b AS (SELECT sum(k) AS st, sum(k * k) AS stt FROM m),
    o AS (SELECT term, sum(n) AS s, sum(n * n) AS ss FROM d GROUP BY 1),
    c AS (SELECT term, sum(n * k) AS sx FROM d JOIN m USING (doc_id) GROUP BY 1),
    r AS (SELECT term, (docs * sx - s * st) / sqrt((docs * ss - s * s) * (docs * stt - st * st)) AS corr FROM c JOIN o USING (term), b, z
        WHERE term <> (SELECT term FROM p) AND docs * ss - s * s > 0)
    SELECT term, round(corr, 8) AS corr FROM r WHERE corr >= 0.3""",
)
def x20(t):
    dtm = stable(_dtm(t))  # read four times below
    term = X.term_totals(dtm).orderBy(F.desc("n"), "term").first()["term"]
    return X.associations(dtm, "doc_id", term, t.documents.count(), 0.3).withColumn("corr", F.round("corr", 8))


def _texts(t):
    return t.documents.select("doc_id", "text")


TOPICS, STEPS, SEED, TERM_PRIOR = 2, 20, 1234, "0.1::DOUBLE"


def _topics_sql() -> str:
    """The steps of ``topics.fit_topics`` for two topics, one after the other."""
    first = f"CASE WHEN floor({unit_sql(SEED, 'doc_id')} * 2) = {{0}} THEN 0.9::DOUBLE ELSE 0.1::DOUBLE END"
    steps = [f"cells AS MATERIALIZED ({DTM_SQL})", "size AS (SELECT count(DISTINCT term)::DOUBLE AS v FROM cells)"]
    steps.append(f"g0 AS (SELECT doc_id, term, n * {first.format(0)} AS r0, n * {first.format(1)} AS r1 FROM cells)")
    for s in range(STEPS + 1):
        steps.append(f"t{s} AS MATERIALIZED (SELECT term, sum(r0) AS t0, sum(r1) AS t1 FROM g{s} GROUP BY 1)")
        steps.append(f"o{s} AS MATERIALIZED (SELECT sum(t0) AS o0, sum(t1) AS o1 FROM t{s})")
        if s == STEPS:
            break
        steps.append(f"d{s} AS MATERIALIZED (SELECT doc_id, sum(r0) AS d0, sum(r1) AS d1 FROM g{s} GROUP BY 1)")
        pull = [f"(t{i} + {TERM_PRIOR}) / (o{i} + v * {TERM_PRIOR}) * (d{i} + 0.5::DOUBLE) AS q{i}" for i in (0, 1)]
        steps.append(f"""g{s + 1} AS MATERIALIZED (SELECT doc_id, term, n * q0 / (q0 + q1) AS r0, n * q1 / (q0 + q1) AS r1 FROM
            (SELECT doc_id, term, n, {", ".join(pull)} FROM cells JOIN t{s} USING (term) JOIN d{s} USING (doc_id), o{s}, size))""")
    beta = [f"(t{i} + {TERM_PRIOR}) / (o{i} + v * {TERM_PRIOR}) AS b{i}" for i in (0, 1)]
    return f"WITH {', '.join(steps)}, beta AS MATERIALIZED (SELECT term, {', '.join(beta)} FROM t{STEPS}, o{STEPS}, size)"


def _mix_sql(cells: str) -> str:
    """The steps of ``TopicModel.document_topics`` over a table of cells, after :func:`_topics_sql`."""
    steps = [f"m AS MATERIALIZED (SELECT c.doc_id, n, b0, b1 FROM {cells} c JOIN beta USING (term))"]
    steps.append(f"h0 AS MATERIALIZED (SELECT DISTINCT doc_id, 0.5::DOUBLE AS h0, 0.5::DOUBLE AS h1 FROM {cells})")
    for s in range(TP.MIX_STEPS):
        steps.append(f"""h{s + 1} AS MATERIALIZED (SELECT doc_id, x0 / (x0 + x1) AS h0, x1 / (x0 + x1) AS h1 FROM (SELECT h.doc_id,
            0.5::DOUBLE + sum(coalesce(n * b0 * h0 / (b0 * h0 + b1 * h1), 0)) AS x0, 0.5::DOUBLE + sum(coalesce(n * b1 * h1 / (b0 * h0 + b1 * h1), 0)) AS x1
            FROM h{s} h LEFT JOIN m ON h.doc_id = m.doc_id GROUP BY 1))""")
    return f"{', '.join(steps)}, mix AS (SELECT * FROM h{TP.MIX_STEPS})"


TOPICS_SQL = _topics_sql()
LONG_SQL = "(SELECT 1 AS topic, term, b0 AS beta FROM beta UNION ALL SELECT 2, term, b1 FROM beta)"
MIX_OUT_SQL = "SELECT doc_id, round(h0, 5) AS share_1, round(h1, 5) AS share_2 FROM mix"


def _model(t):
    return TP.fit_topics(_texts(t), "doc_id", "text", TOPICS, SEED, STEPS)


def _shares(mixed):
    return mixed.select("doc_id", *[F.round(F.col("gamma")[i], 5).alias(f"share_{i + 1}") for i in range(TOPICS)])


@query(
    "X21_topic_model",
    TOPICS_SQL + f"""SELECT topic, term, round(beta, 9) AS beta, CAST(rank AS INTEGER) AS rank FROM
    (SELECT *, rank() OVER (PARTITION BY topic ORDER BY round(beta, 12) DESC) AS rank FROM {LONG_SQL}) WHERE rank <= 20""",
)
def x21(t):
    return TP.top_terms(_model(t).topic_terms(), 20).withColumn("beta", F.round("beta", 9))


@query("X22_topic_terms", TOPICS_SQL + f"SELECT topic, term, round(beta, 9) AS beta FROM {LONG_SQL}")
def x22(t):
    return _model(t).topic_terms().withColumn("beta", F.round("beta", 9))


@query("X23_document_topics", f"{TOPICS_SQL}, {_mix_sql('cells')} {MIX_OUT_SQL}")
def x23(t):
    return _shares(_model(t).document_topics(_texts(t), "text"))


@query(
    "X24_pasted_terms",
    TOPICS_SQL + f"""SELECT topic, string_agg(term, ', ' ORDER BY rank) AS terms FROM
    (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(beta, 12) DESC, term) AS rank FROM {LONG_SQL}) WHERE rank <= 6 GROUP BY 1""",
)
def x24(t):
    return TP.pasted_terms(_model(t).topic_terms(), 6)


UNSEEN_SQL = f"""unseen AS (SELECT item_id AS doc_id, word AS term, count(*) AS n FROM (SELECT item_id, unnest({WORDS_SQL}) AS word FROM benchmark)
    WHERE length(word) >= 3 GROUP BY 1, 2)"""


@query("X25_score_unseen", f"{TOPICS_SQL}, {UNSEEN_SQL}, {_mix_sql('unseen')} {MIX_OUT_SQL}")
def x25(t):
    return _shares(_model(t).document_topics(t.benchmark.select(F.col("item_id").alias("doc_id"), "text"), "text"))


@query(
    "X26_term_assignment",
    f"""{TOPICS_SQL}, {_mix_sql('cells')} SELECT term, CASE WHEN round(h1 * b1, 15) > round(h0 * b0, 15) THEN 2 ELSE 1 END AS topic, count(*) AS n
    FROM cells JOIN beta USING (term) JOIN mix USING (doc_id) GROUP BY 1, 2""",
)
def x26(t):
    return R.count_by(_model(t).assign_terms(_texts(t), "text"), ["term", "topic"])
