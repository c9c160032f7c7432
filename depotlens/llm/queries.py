"""The registered queries of this package: thin contracts over the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.llm import (
    best_fit, chat, katz, mixing, near_duplicates, packing, phrases, prefix_trie, quality, sharding, substrings, token_counts, vectors,
)
from depotlens.llm.literals import literal_table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_dedup(spark, sf_dir):
    found = near_duplicates.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), shingle=2)
    return found.select("doc_id", F.col("n_shingles"), "component_id", "kept")


def op2_source_mix(spark, sf_dir):
    mixed, plan = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source"))
    rows = [{"_name": n, "source_size": s, "target": t} for n, s, t in plan.sources]
    table = F.broadcast(literal_table(spark, rows, "_name string, source_size long, target double"))
    joined = mixed.join(table, F.col("source").eqNullSafe(F.col("_name")))
    return joined.select("doc_id", "size", "source_size", "target", "taken")


def op3_katz_scores(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return katz.score_documents(documents(spark, sf_dir), held_out)


def op4_quality_rules(spark, sf_dir):
    judged = quality.judge(documents(spark, sf_dir).select("doc_id", "text", "lang"))
    return judged.select("doc_id", *quality.RESULTS)


def op5_packing(spark, sf_dir):
    packed = packing.pack_documents(documents(spark, sf_dir), tokenizer_path())
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_vector_dedup(spark, sf_dir):
    return vectors.near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_substring_dedup(spark, sf_dir):
    done = substrings.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    joined = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(joined.cast("binary"), 256).alias("kept_sha256"))


def op8_chat_format(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    rows = [{"conv_id": -7, "turn": i, "role": role, "text": said} for i, role in enumerate(("user", "assistant"))]
    added = literal_table(spark, rows, "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_conversations(given.unionByName(added)))


def op9_shards(spark, sf_dir):
    found = sharding.assign_shards(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_token_counts(spark, sf_dir):
    return token_counts.count_by_section(documents(spark, sf_dir), tokenizer_path())


def op11_collocations(spark, sf_dir):
    return phrases.collocations(documents(spark, sf_dir))


def op12_best_fit_packing(spark, sf_dir):
    packed = best_fit.pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_prefix_trie(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.prefix_trie(prefix_trie.shared_starts(rows))


QUERIES: dict[str, Query] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_source_mix": op2_source_mix,
    "op3_katz_scores": op3_katz_scores,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_vector_dedup": op6_vector_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_chat_format": op8_chat_format,
    "op9_shards": op9_shards,
    "op10_token_counts": op10_token_counts,
    "op11_collocations": op11_collocations,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_prefix_trie": op13_prefix_trie,
}

# The mix: shares by weight with caps, then a line of words per source in the order of a seeded hash.
OP2_SQL = """
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS words FROM docs GROUP BY source
), weighed AS (
  SELECT *, 2.0::DOUBLE * words AS cap,
         ([5.0, 2.0, 1.0]::DOUBLE[])[1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight,
         1.5::DOUBLE * (SELECT sum(words) FROM sources)::DOUBLE AS total
  FROM sources
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, encode(source) NULLS LAST) AS n,
         (total - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shares AS (
  SELECT source, words,
         least(cap, weight * (SELECT arg_min(level, n) FILTER (cap / weight >= level) FROM ordered)) AS target
  FROM ordered
), placed AS (
  SELECT d.doc_id, d.size, s.words, s.target, floor(s.target)::BIGINT AS flow,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM docs d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size, words AS source_size, target,
       (greatest(0, least(size, flow - place)) + greatest(0, least(size, flow - place - words)))::BIGINT AS taken
FROM placed
"""

OP8_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) t(i, role)
), sized AS (
  SELECT *, len(text) + len(regexp_replace(text, '[^\[\]<]+', '', 'g')) AS inside,
         len(role) + len(regexp_replace(role, '[^\[\]<]+', '', 'g')) AS naming,
         CASE WHEN role = 'assistant' THEN text ELSE '' END AS learnt
  FROM turns
), formatted AS (
  SELECT *, CASE role WHEN 'user' THEN len('<s>[INST] ') + inside + len(' [/INST]')
                      WHEN 'assistant' THEN len(' ') + inside + len(' </s>')
                      ELSE len('<s>[ROLE ] ') + naming + inside + len(' [/ROLE]') END AS size
  FROM sized
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(len(learnt))::BIGINT AS loss_chars,
       sha256(string_agg(learnt, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM formatted GROUP BY conv_id
"""


OP6_SQL = """
WITH RECURSIVE usable AS (
  SELECT row_number() OVER () AS uid, vec_id, embedding::DOUBLE[] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.uid <> b.uid AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang
), grams AS (
  SELECT lang, unnest(list_transform(range(1, len(w) + 2 - size), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase, size
  FROM split, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size
), counted AS (
  SELECT lang, phrase, size, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
  SELECT lang, phrase, size, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM counted WHERE size > 1)
), scored AS (
  SELECT c.*, l.a AS l, r.a AS r, (1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cuts c JOIN counted l ON l.lang = c.lang AND l.phrase = c.first JOIN counted r ON r.lang = c.lang AND r.phrase = c.rest
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM lowest c WHERE NOT EXISTS (
    SELECT 1 FROM counted t WHERE c.size = 2 AND t.size = 3 AND t.lang = c.lang AND 100 * t.a >= 50 * c.a
      AND (starts_with(t.phrase, c.phrase || ' ') OR ends_with(t.phrase, ' ' || c.phrase)))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


OP13_SQL = """
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
), turns AS (
  SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS k, list(chars ORDER BY turn NULLS FIRST, k) AS chars
  FROM (SELECT conv_id, turn, len(coalesce(text, '')) AS chars,
               md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
        FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id
), hashed AS (
  SELECT turns.*, list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)) AS bytes, t
  FROM turns, crc_table
), started AS (
  SELECT conv_id, k, chars,
         xor(4294967295, list_reduce(bytes, lambda c, b: xor(c >> 8, t[1 + xor(c & 255, b)]))) % 6 AS h
  FROM hashed
), rebuilt AS (
  SELECT s.conv_id, list_concat(coalesce(b.k[1:h], []), s.k[h + 1:]) AS k,
         list_concat(coalesce(b.chars[1:h], []), s.chars[h + 1:]) AS chars
  FROM started s LEFT JOIN turns b ON b.conv_id = s.conv_id - s.conv_id % 100
), members AS (
  SELECT conv_id, len(k) AS size, d, k[1:d] AS path, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS last
  FROM (SELECT *, unnest(range(0, len(k) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(last) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256
  FROM members GROUP BY d, path
), families AS (
  SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), counted AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN families USING (d, path)
), subtrees AS (
  SELECT path[1:up] AS path, up AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM counted) GROUP BY ALL
)
SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees s ON s.d = c.d AND s.path = c.path
LEFT JOIN nodes p ON p.d = c.d - 1 AND p.path = c.path[1:c.d - 1]
"""


def _op4_sql() -> str:
    lists = ", ".join(f"('{name}', {i}, {words!r})" for i, (name, words) in enumerate(quality.COMMON_WORDS.items()))
    known = ", ".join(f"'{k}'" for k in quality.COMMON_WORDS)
    left, lengths = "text", ["len(text)"]
    for pattern in quality.CLASSES.values():
        left = f"regexp_replace({left}, '{pattern}', '', 'g')"
        lengths.append(f"len({left})")
    chars = ", ".join([f"{a} - {b}" for a, b in zip(lengths, lengths[1:])] + [lengths[-1]])
    rules = quality.QualityRules()
    return f"""
WITH lists(name, ord, listed) AS (VALUES {lists}), docs AS (
  SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text,
         CASE WHEN lang IN ({known}) THEN lang ELSE 'other' END AS grp, trim(coalesce(lang, '')) = '' AS blank
  FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM docs
), windows AS (
  SELECT uid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT uid, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), again AS (
  SELECT uid, i FROM (SELECT uid, i, count(*) OVER (PARTITION BY uid, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT uid, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY uid
), figures AS (
  SELECT s.uid, doc_id, grp, blank, words, len(words)::BIGINT AS n_words,
         len(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, [{chars}] AS chars
  FROM split s LEFT JOIN covered c USING (uid)
), based AS (
  SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.most_repeated_percent} * n_words AS base_failed,
         list_sum(chars) >= {rules.char_guard} AS char_speaks, n_words >= {rules.word_guard} AS word_speaks
  FROM figures
), histograms AS (
  SELECT uid, grp, blank, name, ord, NOT base_failed AND char_speaks AND word_speaks AS typical, 1 AS kind,
         list_append(list_transform(listed, lambda x: len(list_filter(words, lambda w: w = x))),
                     len(list_filter(words, lambda w: NOT list_contains(listed, w)))) AS h
  FROM based JOIN lists ON grp = name OR grp = 'other'
  UNION ALL
  SELECT uid, grp, blank, name, ord, NOT base_failed AND char_speaks AND word_speaks, 0, chars
  FROM based JOIN (SELECT name, ord FROM lists UNION ALL SELECT 'pool', 99) ON grp = name OR grp = 'other'
), guesses AS (
  SELECT uid, name FROM histograms WHERE typical AND grp = 'other' AND blank AND kind = 1 AND list_sum(h) > h[len(h)]
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY list_sum(h) - h[len(h)] DESC, ord) = 1
), bins AS (
  SELECT uid, grp, name, kind, typical, i, h[i] AS v FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM histograms)
), named AS (
  SELECT name, kind, i, sum(v) AS v FROM bins WHERE typical AND grp = name GROUP BY ALL
), reference AS (
  SELECT *, TRUE AS for_all FROM named
  UNION ALL SELECT name, kind, i, sum(v), FALSE FROM bins JOIN guesses USING (uid, name)
  WHERE name NOT IN (SELECT name FROM named) GROUP BY ALL
  UNION ALL SELECT name, kind, i, sum(v), FALSE FROM bins WHERE typical AND name = 'pool' GROUP BY ALL
), shares AS (
  SELECT b.uid, b.name, b.kind, b.v / nullif(sum(b.v) OVER own, 0)::DOUBLE AS p, r.v / nullif(sum(r.v) OVER own, 0)::DOUBLE AS q
  FROM bins b JOIN reference r ON r.name = b.name AND r.kind = b.kind AND r.i = b.i AND (for_all OR grp = 'other')
  WINDOW own AS (PARTITION BY b.uid, b.name, b.kind)
), distances AS (
  SELECT uid, kind, name, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(p * 2 / (p + q)) / 2 ELSE 0 END
                                             + CASE WHEN q > 0 THEN q * log2(q * 2 / (p + q)) / 2 ELSE 0 END))) AS d
  FROM shares GROUP BY uid, kind, name
), nearest AS (
  SELECT uid, min(d) FILTER (kind = 0) AS c, min(d) FILTER (kind = 1) AS w FROM distances GROUP BY uid
), judged AS (
  SELECT b.*, CASE WHEN char_speaks THEN round(c, 6) END AS char_distance,
         CASE WHEN word_speaks AND NOT coalesce(grp = 'other' AND NOT blank AND round(w, 6) > {rules.word_distance}, FALSE)
              THEN round(w, 6) END AS word_distance
  FROM based b LEFT JOIN nearest USING (uid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance,
       NOT base_failed AND coalesce(char_distance, 0) <= {rules.char_distance}
         AND coalesce(word_distance, 0) <= {rules.word_distance} AS kept
FROM judged
"""


ORACLES: dict[str, str] = {
    "op2_source_mix": OP2_SQL,
    "op4_quality_rules": _op4_sql(),
    "op6_vector_dedup": OP6_SQL,
    "op8_chat_format": OP8_SQL,
    "op11_collocations": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
