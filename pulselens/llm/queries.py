"""The registered queries of the operators (``Q``) and their DuckDB SQL where SQL can express them (``ORACLES``).

Each query reads its whole table through the operator and derives the result columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulselens.session import shared_dir

from . import chat, cws, decontaminate, htmltext, langid, mixing, phrases, quality, simhash, spelling, stages, substring, tokencount, tokenfile


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _read(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.learn(pages))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document in the public byte-level vocabulary of 50k entries."""
    import public_tokenizers
    return tokencount.count_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = _read(spark, sf_dir, "documents")
    out = langid.identify(docs, stages.language_model(docs))
    return out.select("doc_id", stages.held_out(stages.LANG_HELD_OUT, 4).alias("held_out"), "lang_pred", "score")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a mix whose sources weigh the square root of their size."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, block_docs=8, period=1000)


def op5_cws_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64 weighted samples of every document and of its edited text, and their likenesses."""
    return cws.fingerprints(_read(spark, sf_dir, "documents"), samples=64)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 13-word windows that a smaller doc_id holds are removed; digests of what is left."""
    out = substring.factors(_read(spark, sf_dir, "documents"), window=13)
    joined = F.trim(F.regexp_replace(F.coalesce("kept", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(joined, 256).alias("kept_sha256"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, formatted and read back."""
    talk = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)],
                                  "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(talk.unionByName(probe)))


def op8_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of those that are not held out."""
    return quality.score_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"),
                                 stages.held_out(0, 5), threshold=0.3)


def op9_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-bit SimHash over 4-word shingles; fingerprints of 4 or fewer differing bits link."""
    out = simhash.near_duplicates(_read(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items it leaks (13 aligned words or more, four of five equal)."""
    out = decontaminate.find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", (F.size("matches") > 0).alias("contaminated"),
                      F.array_sort(F.array_distinct("matches.item_id")).alias("item_ids"),
                      F.coalesce(F.array_max("matches.n_words"), F.lit(0)).alias("longest_overlap"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents (one run in 97 misspelt by rule) with the near word that is their form, and its root."""
    return spelling.variants(_read(spark, sf_dir, "documents"), misspell=97)


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two to four words that occur together more than their parts do."""
    return phrases.collocations(_read(spark, sf_dir, "documents"), threshold=30, max_words=4, top=2000, share=80)


def op13_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written in blocks to the shared folder and read back."""
    import public_tokenizers
    path = shared_dir(spark, "token-ids")
    tokenfile.write_ids(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path, end_id=1)
    return tokenfile.read_documents(spark, path)


Q = {
    "op1_html_extract": op1_html_extract,
    "op2_token_counts": op2_token_counts,
    "op3_language_id": op3_language_id,
    "op4_source_mix": op4_source_mix,
    "op10_decontaminate": op10_decontaminate,
    "op5_cws_fingerprints": op5_cws_fingerprints,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_chat_format": op7_chat_format,
    "op8_quality_qda": op8_quality_qda,
    "op9_simhash_golay": op9_simhash_golay,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_token_ids": op13_token_ids,
}

ORACLES = {
    "op12_phrase_mining": r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, m, w[i:i + m - 1] AS g FROM (
        SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, range(1, 5) r(m) WHERE len(w) >= m)),
f AS (SELECT lang, m, g, count(*) AS f FROM g GROUP BY lang, m, g HAVING count(*) >= 30),
c AS (SELECT lang, m, g, f AS a FROM f WHERE m >= 2),
cuts AS (SELECT c.lang, c.g, c.a, x.f AS l, y.f AS r, k,
                CAST(2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f::HUGEINT) AS BIGINT) AS score
         FROM c, range(1, 4) s(k) JOIN f x ON x.lang = c.lang AND x.m = k AND x.g = c.g[1:k]
              JOIN f y ON y.lang = c.lang AND y.m = c.m - k AND y.g = c.g[k + 1:c.m] WHERE k < c.m),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
around AS (SELECT lang, g[i:i + q - 1] AS g, max(a) AS longer
           FROM (SELECT lang, g, a, m, q, unnest(range(1, m - q + 2)) AS i FROM c, range(2, 4) z(q) WHERE q < m) GROUP BY 1, 2),
kept AS (SELECT scored.*, array_to_string(scored.g, ' ') AS phrase FROM scored LEFT JOIN around USING (lang, g)
         WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
""",
    "op4_source_mix": """
WITH RECURSIVE counts AS (
  SELECT coalesce('=' || source, '') AS key, any_value(source) AS source, count(*) AS n,
         CAST(round(sqrt(CAST(count(*) AS DOUBLE)) * 1000) AS BIGINT) AS w FROM documents GROUP BY 1),
divisor AS (SELECT list_reduce(list(w), lambda a, b: gcd(a, b)) AS g FROM counts),
src AS (SELECT key, n, w // g AS m, row_number() OVER (ORDER BY key) - 1 AS i, CAST(sum(w // g) OVER () AS BIGINT) AS d
        FROM counts, divisor),
lim AS (SELECT least(any_value(d), max(((n // 8 + 1) * d + m - 1) // m)) AS last FROM src),
edf(t, i, m, d, last, k, picked) AS (
  SELECT CAST(-1 AS BIGINT), i, m, d, last, CAST(0 AS BIGINT), false FROM src, lim
  UNION ALL
  SELECT t + 1, i, m, d, last, k + CASE WHEN i = pick THEN 1 ELSE 0 END, i = pick
  FROM (SELECT *, min(CASE WHEN (k * d) // m <= t + 1 THEN (((k + 1) * d + m - 1) // m) * 1000000 + i END) OVER ()
               % 1000000 AS pick FROM edf WHERE t + 1 < last)),
slots AS (SELECT i, k - 1 AS j, t AS slot FROM edf WHERE picked),
ends AS (SELECT min(((n // 8) // m) * d + slot) AS horizon FROM src JOIN slots USING (i) WHERE j = (n // 8) % m),
ranked AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY coalesce('=' || source, '')
                                            ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS r
  FROM documents)
SELECT doc_id, ranked.source, r AS mix_rank, ((r // 8) // m) * d + slot AS mix_slot,
       (((r // 8) // m) * d + slot) * 8 + r % 8 AS mix_pos, ((r // 8) // m) * d + slot < horizon AS mix_on_target
FROM ranked JOIN src ON src.key = coalesce('=' || ranked.source, '')
JOIN slots ON slots.i = src.i AND slots.j = (r // 8) % m, ends
""",
    "op6_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS phrase
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13)),
held AS (SELECT phrase, min(doc_id) AS low FROM win GROUP BY phrase),
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM win JOIN held USING (phrase), range(13) r(o) WHERE low < doc_id),
w AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT w.doc_id, count(*) FILTER (gone.p IS NOT NULL) AS n_removed,
                string_agg(w.word, ' ' ORDER BY w.p) FILTER (gone.p IS NULL) AS text
         FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.p = gone.p GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op7_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, lag(role, 1, '') OVER w AS before, lead(role) OVER w IS NULL AS last,
         length(text) + length(text) - length(replace(text, chr(8288), '')) + len(regexp_extract_all(text,
           '<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|<<TURN>>|<<TEXT>>|<</TURN>>')) AS chars
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(chars + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 25 END)
         AS BIGINT) AS formatted_chars,
       bool_and(CASE before WHEN '' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user'
                WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE false END)
         AND bool_or(last AND role = 'assistant') AS valid_order
FROM t GROUP BY conv_id
""",
}
