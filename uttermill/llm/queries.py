"""One query per operator over its whole table, and the SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttermill.llm import (
    chat, class_model, exact_dedup, merkle, minhash, mixing, packing, pii, spelling, substrings, toxicity, url_filter, vector_graph,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_exact_dedup(spark, sf):
    return exact_dedup.exact_groups(_table(spark, sf, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op2_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM d JOIN g USING (body)
"""

RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


@query
def op5_url_filter(spark, sf):
    return url_filter.judge_urls(_table(spark, sf, "pages"), RULES)


@query
def op8_mixing(spark, sf):
    return mixing.mix_sources(_table(spark, sf, "documents"))


@query
def op3_packing(spark, sf):
    return packing.pack(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_toxicity(spark, sf):
    return toxicity.toxicity(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@query
def op1_minhash(spark, sf):
    return minhash.near_groups(_table(spark, sf, "documents"))


@query
def op6_substrings(spark, sf):
    out = substrings.remove_repeats(_table(spark, sf, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op7_class_model(spark, sf):
    return class_model.class_scores(_table(spark, sf, "documents"))


@query
def op4_vector_graph(spark, sf):
    return vector_graph.near_vectors(_table(spark, sf, "embeddings"))


@query
def op9_personal_data(spark, sf):
    out = pii.personal_data(_table(spark, sf, "documents"))
    return out.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


MANIFEST = ("doc_id", "source", "lang", "n_chars", "text")


@query
def op12_merkle(spark, sf):
    docs = _table(spark, sf, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    later = merkle.leaf_digest([F.col("n_chars") + 1 if c == "n_chars" else c for c in MANIFEST])
    rows = docs.select(
        "doc_id", "lang", merkle.leaf_digest(MANIFEST).alias("leaf"),
        F.when(tampered & F.col("n_chars").isNotNull(), later).alias("now"),
    )
    manifest = merkle.build(rows, "lang", "doc_id", "leaf", ["now"])
    proven = merkle.prove(manifest)
    siblings = F.concat_ws("", F.transform("path", lambda s: s["digest"]))
    folded = proven.withColumn("folded_root", merkle.fold(F.coalesce("now", "digest")))
    return folded.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# CRC-32 of an ASCII string: a table from the polynomial, then one step a byte.
_CRC_TABLE = (
    "[list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) "
    "FOR i IN range(256)]"
)


def _field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


_LEAF = " || ".join(_field(c) for c in MANIFEST)
ORACLE["op12_merkle"] = f"""
WITH RECURSIVE t AS (SELECT {_CRC_TABLE} AS crc),
d AS (
  SELECT doc_id, lang, sha256({_LEAF}) AS leaf, sha256({_LEAF.replace("n_chars", "(n_chars + 1)")}) AS later,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda c, b: xor(c >> 8, t.crc[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, t),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
low AS (
  SELECT tree, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM numbered
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2
  FROM low WHERE n > 1 GROUP BY tree, level, pos // 2),
subroots AS (SELECT tree, h AS subroot FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, tree AS pos, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2 FROM high WHERE n > 1 GROUP BY level, pos // 2),
step AS (
  SELECT x.doc_id, x.lang, x.leaf, x.tree, x.pos, l.level AS k, coalesce(s.h, '') AS sib, (x.pos >> l.level) % 2 = 1 AS lefty
  FROM numbered x JOIN (SELECT DISTINCT tree, level FROM low WHERE n > 1) l ON l.tree = x.tree
  LEFT JOIN low s ON s.tree = x.tree AND s.level = l.level AND s.pos = xor(x.pos >> l.level, 1)
  UNION ALL
  SELECT x.doc_id, x.lang, x.leaf, x.tree, x.pos, 1000 + l.level, coalesce(s.h, ''), (x.tree >> l.level) % 2 = 1
  FROM numbered x CROSS JOIN (SELECT DISTINCT level FROM high WHERE n > 1) l
  LEFT JOIN high s ON s.level = l.level AND s.pos = xor(x.tree >> l.level, 1)),
paths AS (SELECT tree, pos, list({{'sib': sib, 'lefty': lefty}} ORDER BY k) AS path FROM step GROUP BY tree, pos),
proof AS (
  SELECT x.*, subroot, (SELECT h FROM high WHERE n = 1) AS root, coalesce(path, []) AS path,
    CASE WHEN crc % 7 = 0 THEN later ELSE leaf END AS now
  FROM numbered x
  JOIN subroots USING (tree) LEFT JOIN paths USING (tree, pos)),
folded AS (
  SELECT *, list_reduce(list_prepend(now, [(CASE WHEN s.lefty THEN 'L' ELSE 'R' END) || s.sib FOR s IN path]),
    lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root FROM proof)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([s.sib FOR s IN path], '')) AS proof_sha256, folded_root,
  folded_root = root AS verified FROM folded
"""


RUNS = r"[A-Za-zÀ-ÿ]+"


@query
def op13_spelling(spark, sf):
    def damaged(run):
        """One run in 97 of a document loses a code point."""
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run))
        cut = (h % F.length(run)).cast("int")
        shorter = F.concat(F.substr(run, F.lit(1), cut), F.substr(run, cut + 2, F.length(run)))
        return F.when(h % 97 == 0, shorter).otherwise(run)

    docs = _table(spark, sf, "documents")
    words = docs.select("doc_id", F.explode(spelling.runs("text", RUNS)).alias("run")).select(F.array(damaged(F.col("run"))).alias("word"))
    return spelling.variants(spelling.vocabulary(words, F.col("word")))


ORACLE["op13_spelling"] = f"""
WITH RECURSIVE t AS (SELECT {_CRC_TABLE} AS crc),
occurrences AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zA-ZÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM occurrences GROUP BY ALL),
summed AS (
  SELECT run, k, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    [CAST((instr('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', x[2 * i + 2]) - 1 AS BIGINT) FOR i IN range(strlen(x) // 2)]),
    lambda c, b: xor(c >> 8, t.crc[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM counted, t),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, sum(k) AS n
  FROM summed GROUP BY 1 HAVING length(word) >= 5 AND sum(k) >= 3),
cuts AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
holes AS (SELECT word, n, left(word, i) || '*' || substr(word, i + 2) AS p, left(word, i) || substr(word, i + 2) AS d FROM cuts),
links AS (
  SELECT a.word AS x, b.word AS y, b.n AS m FROM holes a JOIN holes b USING (p) WHERE a.word <> b.word
  UNION SELECT w.word, d.word, d.n FROM words w JOIN holes d ON d.d = w.word
  UNION SELECT d.word, w.word, w.n FROM words w JOIN holes d ON d.d = w.word),
best AS (SELECT x, count(*) AS n_near, min({{'l': -m, 'y': encode(y)}}) AS b FROM links GROUP BY x),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.l >= 2 * n THEN decode(b.y) END AS form, CASE WHEN -b.l >= 2 * n THEN -b.l END AS form_n
  FROM words LEFT JOIN best ON x = word),
walk AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.root WHERE forms.form IS NOT NULL),
ends AS (SELECT walk.word, root FROM walk JOIN forms ON forms.word = root WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""


@query
def op11_chat(spark, sf):
    same = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(same).alias("text"),
    )
    out = chat.format_conversations(_table(spark, sf, "conversations").unionByName(extra))
    read = out.select("*", chat.read_turns().alias("turns"), F.concat_ws("", chat.read_loss()).alias("loss"))
    lines = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), F.size(F.flatten("attachments")).cast("bigint").alias("n_attachments"),
        "expanded_tokens",
    )


def _shown(c: str) -> str:
    """Length of a text in the template: embeds become as many characters as their placeholders have."""
    out = f"coalesce({c}, '')"
    for kind, endings in chat.ENDINGS.items():
        mark = "#" * len(chat.placeholder(kind))
        out = rf"regexp_replace({out}, '(?i)!\[[^\]]*\]\([^()\s]+\.(?:{endings})\)', '{mark}', 'g')"
    return rf"length(regexp_replace({out}, '([<\[])(\\*{chat.TAIL})', '\1\\\2', 'g'))"


def _embeds(endings: str) -> str:
    return rf"len(regexp_extract_all(coalesce(text, ''), '(?i)!\[[^\]]*\]\([^()\s]+\.(?:{endings})\)'))"


ORACLE["op11_chat"] = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
c AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS lines,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum({_shown("role")} + {_shown("text")} + {len(chat.START + chat.MESSAGE + chat.STOP)}) + {len(chat.BEGIN + chat.END)} AS formatted_chars,
    sum({" + ".join(_embeds(e) for e in chat.ENDINGS.values())}) AS n_attachments,
    sum({_embeds(chat.ENDINGS["image"])} + 13 * {_embeds(chat.ENDINGS["audio"])} + 512 * {_embeds(chat.ENDINGS["document"])}) AS expanded_tokens
  FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
  n_attachments, expanded_tokens FROM c
"""
