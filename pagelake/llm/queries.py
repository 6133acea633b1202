"""One query per operator over the given tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm import (
    decontaminate,
    divergence,
    editprints,
    extraction,
    jaccard,
    licenses,
    linededup,
    pieces,
    quality,
    rules,
    substring,
    toxicity,
    vectors,
)
from pagelake.llm.labels import held_out

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _scored(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


@query()
def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's quality by the byte network."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    net = quality.train(docs, _table(spark, sf, "labels"))
    return _scored(quality.with_score(docs, net), 0.3)


@query()
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's toxicity, disguised words restored."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf, "labels"))
    return _scored(toxicity.with_score(docs, model), 0.5)


@query()
def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Items' 10-word windows in documents, by suffix automaton."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.match_items(docs, _table(spark, sf, "benchmark"))
    m = F.col("match")
    return found.select(
        "doc_id",
        m["n_words"].alias("n_words"),
        decontaminate.n_hit(m).alias("n_hit"),
        F.size(m["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(m["items"], ","), 256).alias("items_sha256"),
        (F.size(m["items"]) > 0).alias("contaminated"),
    )


@query()
def op2_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's component over 5-word shingle similarity of 0.75 or more."""
    return jaccard.near_duplicates(_table(spark, sf, "documents"))


@query()
def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Words in 50-word windows that an earlier document has, removed."""
    out = substring.remove_repeats(_table(spark, sf, "documents"))
    return out.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query()
def op5_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Every page's main text."""
    pages = _table(spark, sf, "pages").select("page_id", "url", "html")
    out = extraction.with_main_text(pages)
    return out.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query()
def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's counts, base rules and learned decision list."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    out = rules.judge(docs, rules.train(docs, _table(spark, sf, "labels")))
    return out.select("doc_id", *rules.COUNTS, "base_failed", "kept")


def _licences_sql() -> str:
    """The same in SQL, without the size bounds: those change no result."""
    rows = ", ".join(
        f"('{name}', [{', '.join(repr(x) for x in b)}])"
        for name, b in licenses.template_bigrams(licenses.TEMPLATES).items()
    )
    return rf"""
    WITH units AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS unit FROM documents
        UNION ALL
        SELECT doc_id, text FROM documents WHERE contains(text, chr(10))
    ),
    worded AS (
        SELECT doc_id, row_number() OVER () AS u,
               string_split(trim(regexp_replace(lower(unit), '[^0-9a-z]+', ' ', 'g')), ' ') AS w
        FROM units
    ),
    paired AS (
        SELECT doc_id, u, list_distinct(CASE WHEN len(w) = 1 THEN w
            ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS b
        FROM worded WHERE w <> ['']
    ),
    templates(licence, t) AS (VALUES {rows}),
    scored AS (
        SELECT doc_id, u, licence, 2.0::DOUBLE * len(list_intersect(b, t)) / (len(b) + len(t)) AS dice
        FROM paired, templates
    ),
    found AS (SELECT * FROM scored WHERE dice >= {licenses.LEAST}::DOUBLE)
    SELECT d.doc_id, coalesce(n, 0) AS n_notices, coalesce(l, '') AS licences,
           coalesce(m, 0.0::DOUBLE) AS best_dice
    FROM documents d LEFT JOIN (
        SELECT doc_id, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS l,
               max(dice) AS m
        FROM found GROUP BY doc_id
    ) USING (doc_id)"""


@query(_licences_sql())
def op7_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's licence notices."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    x = F.col("notices")
    return licenses.with_notices(docs).select(
        "doc_id",
        F.size(x).cast("bigint").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(x["licence"])), ",").alias("licences"),
        F.coalesce(F.array_max(x["dice"]), F.lit(0.0)).alias("best_dice"),
    )


@query(r"""
    WITH lines AS (
        SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
        FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
                  lambda x: trim(x)), lambda x: x <> '') AS l FROM documents)
    ),
    pairs AS (
        SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM lines
    ),
    firsts AS (
        SELECT *, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, pos) > 1
                  AND next IS NOT NULL AS later
        FROM pairs
    ),
    marked AS (
        SELECT *, later OR coalesce(
            lag(later) OVER (PARTITION BY doc_id ORDER BY pos), false) AS gone
        FROM firsts
    ),
    kept AS (
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted,
               coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS left_over
        FROM marked GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
           sha256(CASE WHEN coalesce(n_deleted, 0) = 0 THEN text ELSE left_over END) AS text_sha256
    FROM documents LEFT JOIN kept USING (doc_id)""")
def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Later copies of runs of two lines or more, deleted."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256")
    )


@query()
def op9_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's piece ids, and whether they spell the text again."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    coded = pieces.with_text(pieces.with_ids(docs), "decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_pieces"),
        "ids",
        F.col("decoded").eqNullSafe(F.col("text")).alias("exact"),
    )


def _codes_sql(rounds: int = vectors.ROUNDS) -> str:
    """Rounds of assignment and means, each as two common table expressions."""
    parts, entries = vectors.PARTS, vectors.ENTRIES
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
    near{r} AS (
        SELECT vec_id, label, part, p, min(gap * {entries} + entry) AS best
        FROM (
            SELECT v.*, entry, list_sum(list_transform(range(1, len(p) + 1),
                lambda i: (p[i] - b.e[i]) * (p[i] - b.e[i])))::BIGINT AS gap
            FROM subs v JOIN book{r} b USING (part)
        ) GROUP BY vec_id, label, part, p
    )""")
        if r < rounds:
            steps.append(f"""
    mean{r} AS (
        SELECT part, entry, list(m ORDER BY d) AS e FROM (
            SELECT part, best % {entries} AS entry, d, floor_div(sum(p[d]), count(*)) AS m
            FROM near{r}, unnest(range(1, len(p) + 1)) AS t(d) GROUP BY ALL
        ) GROUP BY part, entry
    ),
    book{r + 1} AS (
        SELECT part, entry, coalesce(m.e, b.e) AS e FROM book{r} b LEFT JOIN mean{r} m USING (part, entry)
    )""")
    return rf"""
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {vectors.SCALE})::BIGINT) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    subs AS (
        SELECT vec_id, label, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS p
        FROM kept, unnest(range({parts})) AS t(part)
    ),
    firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept),
    book0 AS (SELECT part, entry, p AS e FROM subs JOIN firsts USING (vec_id) WHERE entry < {entries}),
    {",".join(steps)},
    coded AS (
        SELECT vec_id, label, string_agg(printf('%02x', best % {entries}), '' ORDER BY part) AS code,
               sum(best // {entries})::BIGINT AS error
        FROM near{rounds} GROUP BY vec_id, label
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, i))
            FROM (SELECT part, entry, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM book{rounds})
           ) AS codebooks_sha256
    FROM coded""".replace("floor_div(sum(p[d]), count(*))", "(sum(p[d]) - ((sum(p[d]) % count(*)) + count(*)) % count(*)) // count(*)")


@query(_codes_sql())
def op11_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Every usable vector's code of 16 parts, by codebooks of 64 entries."""
    found = vectors.compress(_table(spark, sf, "embeddings"))
    rows = vectors.with_label_error(found.rows)
    return rows.select(
        "vec_id", "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256")
    )


def _divergence_sql() -> str:
    p = f"1 + (({divergence.UNIT}::HUGEINT * ({{n}} + 2)) // ({{t}} + 2 * v))::BIGINT"
    f = "((p - q) * (p - q)) // (p + q)"
    return rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ),
    words AS (
        SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
    ),
    kept AS (
        SELECT lang, term, count(*) AS n FROM words
        GROUP BY lang, term HAVING count(DISTINCT d) >= {divergence.LEAST_DOCS}
    ),
    langs AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS t FROM kept GROUP BY lang),
    own AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (
        SELECT lang, source, coalesce(t, 0) AS t, v FROM (SELECT DISTINCT lang, source FROM docs)
        LEFT JOIN (SELECT lang, source, sum(n)::BIGINT AS t FROM own GROUP BY ALL) USING (lang, source)
        LEFT JOIN (SELECT lang, v FROM langs) USING (lang)
    ),
    full_p AS (
        SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n, {p.format(n="coalesce(o.n, 0)", t="g.t")} AS p
        FROM groups g JOIN kept k USING (lang) LEFT JOIN own o USING (lang, source, term)
    ),
    lang_p AS (SELECT lang, term, {p.format(n="n", t="t")} AS q FROM kept JOIN langs USING (lang)),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum({f.replace("p", "a.p").replace("q", "b.p")})::BIGINT AS value
        FROM full_p a JOIN full_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ),
    every AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
    ),
    terms AS (
        SELECT lang, source, term AS item, {f} AS value
        FROM full_p JOIN lang_p USING (lang, term) WHERE n > 0 AND p > q
    ),
    both_parts AS (SELECT *, 'pair' AS part FROM every UNION ALL SELECT *, 'term' FROM terms)
    SELECT lang, source, part, item, value,
           (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
    FROM both_parts
    QUALIFY part = 'pair' OR rank <= 10"""


@query(_divergence_sql())
def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    """Every source against the others of its language, and its own terms."""
    found = divergence.audit(_table(spark, sf, "documents"))
    pairs = divergence.ranked_sources(found).withColumn("part", F.lit("pair"))
    terms = divergence.ranked_terms(found).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


@query()
def op13_edit_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's fingerprint against its edit's and its neighbour's, and the
    smallest id of its near copies.
    """
    found = editprints.against_next(_table(spark, sf, "documents"))
    copies = editprints.near_copies(found, "doc_id")
    return found.join(copies, "doc_id", "left")
