"""The operators bound to the given tables, each beside its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm import (
    conversation_repair,
    decontaminate,
    embedding_dedup,
    fill_in_middle,
    language_id,
    license_scan,
    mixing,
    ngram_join,
    pii,
    suffix_dedup,
    token_files,
    toxicity,
    url_filter,
)
from furrow.llm.common import broadcast_if_small
from furrow.session import scratch_path, settle


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), k=3, percent=90, count_links=True).withColumnRenamed("id", "doc_id")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_copies(_table(spark, sf_dir, "embeddings"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.fit(pages))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(_table(spark, sf_dir, "documents"))
    return found.drop("spans")


def _remainder(of: int) -> Column:
    """crc32 of the document's id as text, modulo ``of``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(_remainder(4) != 2))
    held = F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out")
    return language_id.predict(docs, model).select("doc_id", held, "lang_pred", "score")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learned from the labelled documents whose remainder by 5 is not 0."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(_remainder(5) != 0).select("doc_id", "toxic")
    # The chosen labels are bounded in number, so the texts are not shuffled for them.
    chosen, sizes = toxicity.choose_labels(labels)
    return toxicity.fit(docs.join(broadcast_if_small(chosen), docs["doc_id"] == chosen["id"]), sizes)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(_table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    held = F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", "predicted")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(_table(spark, sf_dir, "documents"), seed="42", share=50, spm_share=80)
    back = fill_in_middle.restored_sha256(F.col("output"), F.col("form")).alias("restored_sha256")
    return made.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", "output_sha256", back)


#: The tokenizer of op12; any other vocabulary file will do as well.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_documents(_table(spark, sf_dir, "documents"), path, TOKENIZER, end_id=1)
    return token_files.checksums(token_files.read(spark, path))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the damage that op13 repairs; nulls count as one space."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times))
    ).drop("col")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = _table(spark, sf_dir, "conversations")
    rows = damaged(whole)
    plans = settle(conversation_repair.plans(rows))
    hashed = conversation_repair.repaired_digests(rows, plans)
    found = plans.join(hashed.withColumnRenamed("conv", "own"), F.col("conv").eqNullSafe(F.col("own")))
    every = whole.select(F.col("conv_id").cast("long")).distinct()
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, every["conv_id"].eqNullSafe(F.col("conv")), "left").select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_license_scan": op5_license_scan,
    "op6_language_id": op6_language_id,
    "op7_source_mixing": op7_source_mixing,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_pii": op10_pii,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_token_files": op12_token_files,
    "op13_conversation_repair": op13_conversation_repair,
}

#: Fixed values of the queries: word pattern, thresholds, weights and shares.
SQL: dict[str, str] = {
    "op7_source_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k
  FROM sized GROUP BY source),
limits AS (
  SELECT *, source_size * 2 AS lim, CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM per),
ranked AS (
  SELECT *, lim::DOUBLE / weight AS ratio, sum(source_size) OVER ()::DOUBLE AS words, sum(weight) OVER ()::DOUBLE AS weights,
    coalesce(sum(lim) OVER before, 0)::DOUBLE AS lim_before, coalesce(sum(weight) OVER before, 0)::DOUBLE AS weight_before
  FROM limits
  WINDOW before AS (ORDER BY lim::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, (least(words * 150 / 100.0::DOUBLE, words * 2) - lim_before) / (weights - weight_before) AS own FROM ranked),
chosen AS (SELECT own AS level FROM levels WHERE ratio > own ORDER BY ratio, source NULLS LAST LIMIT 1),
goals AS (
  SELECT source, source_size,
    CASE WHEN level IS NULL OR ratio <= level THEN lim::DOUBLE ELSE weight * level END AS target,
    ('0x' || substr(md5('mix' || coalesce('=' || source, '')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0::DOUBLE AS shift
  FROM levels LEFT JOIN chosen ON true),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS LAST) - 1 AS before FROM sized),
rated AS (
  SELECT p.doc_id, p.size, g.source_size, g.target, p.before, g.shift,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate
  FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (size * least(floor((before + 1) * rate + shift) - floor(before * rate + shift), 2))::BIGINT AS taken
FROM rated""",
    "op1_ngram_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, a AS other FROM both_ways UNION SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON r.other = e.a)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(min(r.other), d.doc_id)) AS component_id,
  coalesce(l.n, 0)::BIGINT AS n_links
FROM documents d LEFT JOIN sizes z USING (doc_id) LEFT JOIN reach r USING (doc_id)
  LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM both_ways GROUP BY a) l USING (doc_id)
GROUP BY d.doc_id, z.n, l.n""",
    "op3_embedding_near_dedup": r"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT a AS vec_id, a AS other FROM links UNION SELECT r.vec_id, e.b FROM reach r JOIN links e ON r.other = e.a),
least_of AS (SELECT vec_id, min(other) AS c FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c, e.vec_id) AS component_id, coalesce(c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n USING (vec_id) LEFT JOIN least_of USING (vec_id)""",
    "op8_suffix_array_dedup": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
windows AS (
  SELECT doc_id, i - 1 AS start, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
repeated AS (SELECT h FROM windows GROUP BY h HAVING min(doc_id) <> max(doc_id)),
places AS (SELECT doc_id, start FROM windows JOIN repeated USING (h)),
cut AS (
  SELECT *, CASE WHEN start > lag(start) OVER (PARTITION BY doc_id ORDER BY start) + 50 THEN 1 ELSE 0 END AS new FROM places),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY start) AS span FROM cut)
SELECT doc_id, min(start)::BIGINT AS start_word, (max(start) + 50)::BIGINT AS end_word, (max(start) + 50 - min(start))::BIGINT AS n_words
FROM numbered GROUP BY doc_id, span""",
    "op11_fill_in_middle": r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, tokens, len(tokens)::BIGINT AS n, ('0x' || substr(h, 1, 8))::UBIGINT::BIGINT AS h1, ('0x' || substr(h, 9, 8))::UBIGINT::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::UBIGINT::BIGINT AS h3, ('0x' || substr(h, 25, 8))::UBIGINT::BIGINT AS h4 FROM cut),
placed AS (
  SELECT doc_id, text, tokens, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(tokens[1:a], '') AS p, array_to_string(tokens[a + 1:b], '') AS m, array_to_string(tokens[b + 1:n], '') AS s
  FROM placed),
made AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output FROM parts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(output) AS output_sha256, CASE WHEN form = 'plain' THEN sha256(output) ELSE sha256(p || m || s) END AS restored_sha256
FROM made""",
    "op13_conversation_repair": r"""
WITH RECURSIVE remainders AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n] || range(8),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
keyed AS (
  SELECT *, [4294967295] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
    lambda c: ascii(c)::BIGINT) AS bytes FROM conversations),
kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(bytes, lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 20 AS kind
  FROM keyed CROSS JOIN remainders),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
  FROM damaged),
coded AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN trimmed = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault
  FROM ranked),
inserts(q, q2, c, a, r) AS (VALUES
  (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 2, 3, 'I', 'user:' || chr(10)), (1, 2, 3, 'I', 'user:' || chr(10)), (3, 2, 3, 'I', 'user:' || chr(10)), (2, 3, 3, 'I', 'assistant:' || chr(10)),
  (0, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (1, 3, 6, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
wants(q, w) AS (VALUES (0, 'u'), (1, 'u'), (2, 'a'), (3, 'u')),
least_cost AS (
  SELECT k.conv_id, 0::BIGINT AS i, x.q2 AS q, {'c': x.c, 'a': x.a, 'r': x.r} AS best
  FROM (SELECT DISTINCT conv_id FROM coded) k CROSS JOIN (SELECT * FROM inserts WHERE q = 0) x
  UNION ALL
  SELECT conv_id, i, q, best FROM (
    SELECT s.conv_id, s.i, x.q2 AS q, min({'c': s.c + x.c, 'a': s.a || x.a, 'r': s.r || x.r}) AS best
    FROM (
      SELECT p.conv_id, k.i, p.q, p.best.c + 4 AS c, p.best.a || 'D' AS a, p.best.r AS r
      FROM least_cost p JOIN coded k ON p.conv_id IS NOT DISTINCT FROM k.conv_id AND k.i = p.i + 1
      UNION ALL
      SELECT p.conv_id, k.i, CASE WHEN k.initial = 's' THEN 1 WHEN w.w = 'u' THEN 2 ELSE 3 END, p.best.c + CASE k.fault WHEN 't' THEN 3 ELSE 0 END,
        p.best.a || 'K', p.best.r || k.role || ':' || k.text || chr(10)
      FROM least_cost p JOIN wants w USING (q) JOIN coded k ON p.conv_id IS NOT DISTINCT FROM k.conv_id AND k.i = p.i + 1
      WHERE k.fault IN ('t', '-') AND (k.initial = w.w OR (p.q = 0 AND k.initial = 's'))
      UNION ALL
      SELECT p.conv_id, k.i, CASE WHEN w.w = 'u' THEN 2 ELSE 3 END, p.best.c + CASE k.fault WHEN 't' THEN 6 ELSE 3 END,
        p.best.a || 'R', p.best.r || CASE w.w WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || k.text || chr(10)
      FROM least_cost p JOIN wants w USING (q) JOIN coded k ON p.conv_id IS NOT DISTINCT FROM k.conv_id AND k.i = p.i + 1
      WHERE k.fault IN ('t', '-')) s
    JOIN inserts x ON s.q = x.q GROUP BY s.conv_id, s.i, x.q2)),
neighbours AS (SELECT *, lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS next FROM coded),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (next IS NOT NULL AND initial || next NOT IN ('su', 'ua', 'au')) AS illegal
  FROM neighbours GROUP BY conv_id),
done AS (
  SELECT c.conv_id, min(l.best) AS best FROM counts c JOIN least_cost l ON l.conv_id IS NOT DISTINCT FROM c.conv_id AND l.i = c.n AND l.q IN (0, 3)
  GROUP BY c.conv_id)
SELECT d.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
  coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(b.best.c, 0)::BIGINT AS cost,
  coalesce(b.best.a, '') AS audit, sha256(coalesce(b.best.r[1:length(b.best.r) - 1], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN done b ON b.conv_id IS NOT DISTINCT FROM d.conv_id""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
