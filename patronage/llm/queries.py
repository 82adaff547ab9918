"""One query per operator, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronage.llm import chat, divergence, embedding, jaccard, language, mixing, packing, prefix_bpe, quality, sharding, substring, whitening
from patronage.llm.features import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query
def op2_chat_format(spark, d):
    """All conversations and one that holds the template's own control strings."""
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    out = chat.format_chats(rows)
    return (
        out.withColumn("turns", chat.read_turns(F.col("formatted")))
        .withColumn("loss_text", chat.read_loss(F.col("segments")))
        .select(
            "conv_id",
            F.size("turns").cast("bigint").alias("n_turns"),
            F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
            F.length("loss_text").cast("bigint").alias("loss_chars"),
            F.sha2("loss_text", 256).alias("loss_sha256"),
            F.length("formatted").cast("bigint").alias("formatted_chars"),
            "valid",
        )
    )


ORACLES["op2_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t') AS et,
    replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ':', '\c') AS er,
    coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), 'start') AS prev
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(er) + length(et) + 14) AS BIGINT) AS formatted_chars,
  bool_and((prev || '|' || role) IN ('start|system', 'start|user', 'system|user', 'user|assistant', 'assistant|user'))
    AND last(role ORDER BY turn NULLS FIRST, role, text) IN ('user', 'assistant') AS valid
FROM e GROUP BY conv_id
"""


@query
def op3_source_mix(spark, d):
    """Every document with its copies in the mix, in global order; texts travel with them."""
    out = mixing.mix(table(spark, d, "documents"))
    return out.select("doc_id", "source", F.col("copy").cast("bigint"), F.col("n_copies").cast("bigint"), "order_key", F.md5(F.col("text").cast("binary")).alias("text_md5"))


ORACLES["op3_source_mix"] = f"""
WITH share(source, w) AS (VALUES {", ".join(f"('{s}', {w}::DOUBLE)" for s, w in mixing.SHARES.items())}),
named AS (SELECT d.doc_id, d.source, d.text, s.source AS named, s.w FROM documents d LEFT JOIN share s ON s.source = d.source),
n AS (SELECT named, count(*) AS n, (SELECT count(*) FROM documents) AS total,
             coalesce(any_value(w), 1 - (SELECT sum(w) FROM share)) AS w FROM named GROUP BY named),
rate AS (SELECT named, w * total / n AS r FROM n),
step AS (
  SELECT named, k, sum(exp(-r + k * ln(r) - lgamma(k + 1))) OVER (PARTITION BY named ORDER BY k) AS c
  FROM rate, range(0, 400) x(k) WHERE r > 0 AND k < r + 12 * sqrt(r) + 30
),
u AS (
  SELECT doc_id, source, named, md5(text) AS text_md5,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':{mixing.SEED}'), 1, 13))::BIGINT / 16.0::DOUBLE ** 13 AS u
  FROM named
),
drawn AS (
  SELECT u.doc_id, u.source, u.text_md5, count(*) AS n_copies
  FROM u JOIN step s ON s.named IS NOT DISTINCT FROM u.named AND s.c <= u.u GROUP BY ALL
)
SELECT doc_id, source, copy, n_copies, text_md5,
  md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || copy || ':order{mixing.SEED}') AS order_key
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM drawn)
"""


@query
def op5_shards(spark, d):
    """All documents in 16 shards of near equal bytes, equal texts together."""
    out = sharding.shard(table(spark, d, "documents"), 16)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_curve_packing(spark, d):
    """All documents packed along the curve into sequences of at most 1024 tokens."""
    pieces = packing.pack(table(spark, d, "documents"), tokenizer_file(), 1024)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op4_quality_classifier(spark, d):
    """Quality scores of all documents, learned from four folds of the labels."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    model = quality.train_classifier(docs, labels, quality.train_fold(F.col("doc_id")))
    scored = quality.score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op9_quality_rules(spark, d):
    """Base counts and the calibrated verdict on all documents."""
    docs = table(spark, d, "documents")
    return quality.apply_rules(docs.select("doc_id", "text"), quality.train_rules(docs, table(spark, d, "labels"))).drop("text")


@query
def op6_language_id(spark, d):
    """Languages of all documents, learned from three folds of them."""
    docs = table(spark, d, "documents")
    network = language.learn(docs, language.train_fold(F.col("doc_id")))
    named = language.identify(docs.select("doc_id", "text"), network)
    return named.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op10_embedding_dedup(spark, d):
    """Links and components of all vectors of one label with a cosine of 0.93 or more."""
    return embedding.near_duplicates(table(spark, d, "embeddings"), 0.93)


@query
def op8_jaccard_join(spark, d):
    """All documents with the class and the number of their links of a Jaccard similarity of 0.8 or more on five-word shingles."""
    return jaccard.similar_documents(table(spark, d, "documents"), 0.8)


ORACLES["op8_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s FROM w
),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9
),
reach(id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.id, pair.b FROM reach JOIN pair ON pair.a = reach.other)
SELECT d.doc_id, min(r.other) AS class_id, (SELECT count(*) FROM pair p WHERE p.a = d.doc_id) AS n_links
FROM documents d JOIN reach r ON r.id = d.doc_id GROUP BY d.doc_id
"""


@query
def op7_substring_dedup(spark, d):
    """All documents without the words of 20-word windows that lie earlier too."""
    out = substring.remove_repeats(table(spark, d, "documents").select("doc_id", "text"))
    kept = F.array_join(F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""), " ")
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce(kept, F.lit("")), 256).alias("kept_sha256"))


ORACLES["op7_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
),
win AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM w WHERE len(w) >= 20)),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, s + i AS p FROM later, range(0, 20) x(i)),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM w),
kept AS (
  SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.p) AS t, count(*) AS n
  FROM word ANTI JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p GROUP BY word.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""


@query
def op13_prefix_bpe(spark, d):
    """Ids of all documents by prefix tables over the rank file, and the texts that the ids stand for."""
    import public_tokenizers

    ranks = prefix_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    out = prefix_bpe.encode_documents(table(spark, d, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_embedding_whitening(spark, d):
    """The four leading components of all embeddings, whitened."""
    vectors = table(spark, d, "embeddings")
    return whitening.whitened_components(vectors, whitening.fit_whitening(vectors, 4))


@query
def op11_source_divergence(spark, d):
    """Each two sources of a language by how far their words lie apart, and the words that mark each source."""
    return divergence.audit_sources(table(spark, d, "documents"), 200)


ORACLES["op11_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (
  SELECT doc, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d
),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
cnt AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
size AS (
  SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM cnt c WHERE c.lang = g.lang AND c.source = g.source), 0) + coalesce(v.v, 0) AS size
  FROM grp g LEFT JOIN v ON v.lang = g.lang
),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // s.size AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (v.n + v.v) AS q
  FROM size s JOIN kept k ON k.lang = s.lang JOIN v ON v.lang = s.lang
  LEFT JOIN cnt c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 200
"""
