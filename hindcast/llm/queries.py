"""One query per operator over the driver's tables, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from hindcast.llm import (
    licenses,
    mixing,
    packing,
    periodic,
    ppm,
    quality,
    quotes,
    repair,
    rules,
    simhash,
    substring,
    toxicity,
    vectors,
)
from hindcast.llm.common import table


def op1_mix(spark, sf_dir):
    """Words the mix takes from each document."""
    return mixing.taken_words(mixing.mix(mixing.sizes(table(spark, sf_dir, "documents"))))


OP1_SQL = r"""WITH sized AS (
  SELECT doc_id, source,
    CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
    coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS hash
  FROM documents),
s AS (SELECT key, sum(size)::BIGINT AS source_size,
    [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY key) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY key),
caps AS (SELECT *, 2.0::DOUBLE * source_size AS most,
    row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, key) AS k FROM s),
levels AS (SELECT *,
    (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    AS level FROM caps),
goals AS (SELECT key, source_size, CASE WHEN most <= level * weight THEN most
    ELSE least(weight * max(level) FILTER (WHERE most > level * weight) OVER (), most) END AS target
  FROM levels),
placed AS (SELECT key, doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS wanted,
    coalesce(sum(size) OVER (PARTITION BY key ORDER BY hash
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN goals USING (key)),
numbered AS (SELECT *, row_number() OVER (ORDER BY key, start, size, doc_id) AS k FROM placed),
blocks AS (SELECT key, ceil(floor(target + 0.5) / 512)::BIGINT AS blocks FROM goals),
upto AS (SELECT key, blocks, sum(blocks) OVER (ORDER BY key ROWS UNBOUNDED PRECEDING) AS upto,
    sum(blocks) OVER () AS n FROM blocks),
bits AS (SELECT *, CASE WHEN n <= 1 THEN 0 ELSE length(bin((n - 1)::BIGINT)) END AS bits FROM upto WHERE blocks > 0),
points AS (SELECT key, bits, unnest(range((((upto - blocks) * (1::HUGEINT << bits::INT) + n - 1) // n)::BIGINT,
    ((upto * (1::HUGEINT << bits::INT) + n - 1) // n)::BIGINT)) AS j FROM bits),
slots AS (SELECT key, slot, row_number() OVER (PARTITION BY key ORDER BY slot) - 1 AS block FROM (
  SELECT key, coalesce(list_sum([((j >> b) & 1) << (bits - 1 - b) for b in range(bits)]), 0)::BIGINT AS slot FROM points)),
copies AS (SELECT *, start + copy * source_size AS begins, least(start + copy * source_size + size, wanted) AS upto
  FROM numbered, (VALUES (0), (1)) AS c(copy)),
asked AS (SELECT k, key, unnest(range((begins // 512)::BIGINT, ((upto - 1) // 512 + 1)::BIGINT)) AS block
  FROM copies WHERE size > 0 AND begins < upto),
firsts AS (SELECT k, min(slot) AS first_slot FROM asked JOIN slots USING (key, block) GROUP BY k)
SELECT doc_id, size, source_size, target,
  (least(size, greatest(0, wanted - start)) + least(size, greatest(0, wanted - source_size - start)))::BIGINT AS taken,
  first_slot
FROM numbered LEFT JOIN firsts USING (k)"""


def op2_vectors(spark, sf_dir):
    """Vectors linked by a cosine of 0.9 or more, and the groups they form."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


OP2_SQL = """WITH RECURSIVE sound AS (
  SELECT vec_id, row_number() OVER () AS n, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
  ON a.n <> b.n AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM sound UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links,
  coalesce(component_id, vec_id) AS component_id,
  coalesce(vec_id = coalesce(component_id, vec_id), false) AS kept
FROM embeddings e LEFT JOIN least ON least.a = e.vec_id"""


def op3_licenses(spark, sf_dir):
    """License phrases and notices in all documents."""
    return licenses.scan(table(spark, sf_dir, "documents")).drop("matches")


def op4_quotes(spark, sf_dir):
    """All conversations without quotations, messages linked to what they quote."""
    return quotes.conversations(table(spark, sf_dir, "conversations"))


OP4_SQL = r"""WITH RECURSIVE lines AS (
  SELECT conv_id, turn, place, length(regexp_replace(regexp_extract(line, '^[ \t>]*'), '[^>]', '', 'g')) AS depth,
    lower(trim(regexp_replace(regexp_replace(line, '^[ \t>]*', ''), '[ \t\r\n\x0B\f]+', ' ', 'g'))) AS said
  FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS place FROM conversations)),
firsts AS (SELECT conv_id, said, min(turn) AS source_turn FROM lines
  WHERE depth = 0 AND said <> '' AND turn IS NOT NULL GROUP BY ALL),
quoted AS (SELECT l.conv_id, turn, place, depth, source_turn FROM lines l JOIN firsts USING (conv_id, said)
  WHERE depth > 0 AND source_turn < turn),
parents AS (SELECT conv_id, turn, arg_max(source_turn, (-depth, source_turn)) AS parent_turn,
  count(DISTINCT place) AS n_linked FROM quoted GROUP BY conv_id, turn),
up AS (SELECT conv_id, turn, parent_turn AS root_turn, 1 AS depth FROM parents
  UNION ALL SELECT up.conv_id, up.turn, p.parent_turn, up.depth + 1
  FROM up JOIN parents p ON p.conv_id = up.conv_id AND p.turn = up.root_turn),
roots AS (SELECT conv_id, turn, min(root_turn) AS root_turn, max(depth) AS depth FROM up GROUP BY ALL),
own AS (SELECT *, list_filter(string_split(text, chr(10)),
    lambda x: NOT contains(regexp_extract(x, '^[ \t>]*'), '>')) AS plain,
  list_filter(string_split(text, chr(10)), lambda x: contains(regexp_extract(x, '^[ \t>]*'), '>')
    AND trim(regexp_replace(regexp_replace(x, '^[ \t>]*', ''), '[ \t\r\n\x0B\f]+', ' ', 'g')) <> '') AS marked
  FROM conversations)
SELECT o.conv_id, o.turn, role, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(plain, chr(10)) END AS text,
  coalesce(len(marked), 0)::BIGINT AS n_quoted, coalesce(n_linked, 0)::BIGINT AS n_linked, parent_turn,
  coalesce(root_turn, o.turn) AS root_turn, coalesce(depth, 0)::BIGINT AS depth
FROM own o LEFT JOIN parents p ON p.conv_id = o.conv_id AND p.turn = o.turn
  LEFT JOIN roots r ON r.conv_id = o.conv_id AND r.turn = o.turn"""


def op5_quality(spark, sf_dir):
    """Quality of all documents, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op6_simhash(spark, sf_dir):
    """Groups of documents whose fingerprints differ in two bits or fewer."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op7_rules(spark, sf_dir):
    """Counts and verdicts on all documents."""
    return rules.rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_substring(spark, sf_dir):
    """Words in windows of 20 that occur earlier in the corpus."""
    found = substring.removals(table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_packing(spark, sf_dir):
    """Places of all documents in sequences of 4096 tokens."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, capacity=4096, end=1)


def op10_ppm(spark, sf_dir):
    """Code lengths of all documents under a byte-context model, and word frequencies."""
    return ppm.score(table(spark, sf_dir, "documents"))


def op11_toxicity(spark, sf_dir):
    """Toxicity of all documents, learnt from all votes and the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), threshold=0.5)


def op12_repair(spark, sf_dir):
    """All conversations, damaged by a hash of their rows' places and repaired at least cost."""
    rows = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(rows), rows)


def op13_runs(spark, sf_dir):
    """Periodic runs of all documents, some made periodic, and the texts without them."""
    return op13_rows(table(spark, sf_dir, "documents"))


def op13_rows(docs):
    """The digest columns of the runs of these documents."""
    found = periodic.collapsed(periodic.planted(docs), least=12)
    found = found.withColumn("best", periodic.longest(F.col("runs")))
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
        "n_words",
    )


CASES = {
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    "op1_mix": (op1_mix, OP1_SQL),
    "op2_vectors": (op2_vectors, OP2_SQL),
    "op3_licenses": (op3_licenses, None),
    "op4_quotes": (op4_quotes, OP4_SQL),
    "op5_quality": (op5_quality, None),
    "op6_simhash": (op6_simhash, None),
    "op7_rules": (op7_rules, None),
    "op8_substring": (op8_substring, None),
    "op9_packing": (op9_packing, None),
    "op10_ppm": (op10_ppm, None),
    "op11_toxicity": (op11_toxicity, None),
    "op12_repair": (op12_repair, None),
    "op13_runs": (op13_runs, None),
}
