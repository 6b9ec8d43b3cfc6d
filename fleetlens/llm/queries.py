"""Registered queries of the text operators, with the SQL that checks them where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import (
    exact_dedup, fill_middle, html, jaccard, language, mixing, packing, personal, prefix_trie, sharding, spotsigs, substrings,
    token_counts,
)
from fleetlens.llm.text import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The public tokenizers' folder; a file's path is an argument of the operator.
TOKENIZER = "word_bpe_49k.json"
VOCABULARY = "piece_bpe_32k.model"
SHARDS = tuple(f"shard-{k:03d}" for k in range(128))


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op4_permutation_sharding")
def op4(spark, sf_dir):
    return sharding.assign_shards(documents(spark, sf_dir), SHARDS)


@query("op5_exact_dedup", r"""
  WITH t AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents)
  SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
         doc_id = min(doc_id) OVER w AS kept, text_sha256
  FROM t WINDOW w AS (PARTITION BY text_sha256)""")
def op5(spark, sf_dir):
    """The lower half of the ids is the history, the upper half arrives."""
    docs = documents(spark, sf_dir)
    middle = exact_dedup.middle_id(docs)
    return exact_dedup.exact_dedup(docs, F.col("doc_id") <= F.lit(middle))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_harmonic_packing")
def op3(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


@query("op10_language_id")
def op10(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = language.fit(docs, ~language.held_out())
    return language.identify(docs, model).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query("op6_entropy_mixing")
def op6(spark, sf_dir):
    mixed = mixing.mix_sources(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op7_html_extraction")
def op7(spark, sf_dir):
    return html.extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op2_substring_dedup", r"""
  WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
  s AS (
    SELECT doc_id, unnest(range(1, len(words) - 33)) AS pos,
           unnest(list_transform(range(1, len(words) - 33), lambda i: sha256(array_to_string(words[i:i + 34], ' ')))) AS run
    FROM w WHERE len(words) >= 35),
  r AS (SELECT doc_id, pos FROM s QUALIFY count(*) OVER (PARTITION BY run) > 1),
  c AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 35)) AS gone FROM r),
  g AS (SELECT doc_id, list(gone) AS gone FROM c GROUP BY doc_id),
  k AS (
    SELECT doc_id, words, coalesce(gone, []) AS gone,
           list_filter(words, lambda x, i: NOT list_contains(coalesce(gone, []), i)) AS kept
    FROM w LEFT JOIN g USING (doc_id))
  SELECT doc_id, len(words) AS n_words, len(gone) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k""")
def op2(spark, sf_dir):
    cleaned = substrings.remove_repeats(documents(spark, sf_dir))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return cleaned.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


@query("op8_jaccard_join")
def op8(spark, sf_dir):
    return jaccard.jaccard_components(documents(spark, sf_dir), length=4, percent=85)


@query("op1_spotsigs")
def op1(spark, sf_dir):
    report = spotsigs.edit_report(documents(spark, sf_dir))
    return report.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")


@query("op9_token_counts")
def op9(spark, sf_dir):
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer_path(VOCABULARY))


@query("op11_fill_in_middle", r"""
  WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
    FROM documents),
  d AS (
    SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS c1,
           CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS c2,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
                WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM t),
  c AS (
    SELECT *, array_to_string(u[1:least(c1, c2)], '') AS p,
           array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
           array_to_string(u[greatest(c1, c2) + 1:n], '') AS s
    FROM d)
  SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
         CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
         sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
         sha256(text) AS restored_sha256
  FROM c""")
def op11(spark, sf_dir):
    made = fill_middle.fill_in_middle(documents(spark, sf_dir))
    return fill_middle.restore(made, keep_text=False)


# crc32 of the decimal id, bit by bit.
_CRC = """xor(list_reduce(
    [4294967295] || list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
      lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT)),
    lambda c, b: list_reduce([xor(c, b)] || range(0, 8), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


@query("op12_prefix_trie", f"""
  WITH t AS (
    SELECT conv_id, turn, strlen(coalesce(text, '')) AS b,
           substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS g
    FROM conversations WHERE conv_id IS NOT NULL),
  l AS (SELECT conv_id, list({{'g': g, 'b': b}} ORDER BY turn NULLS FIRST, g) AS turns FROM t GROUP BY conv_id),
  h AS (SELECT conv_id, turns, {_CRC} % 9 AS h FROM l),
  r AS (
    SELECT h.conv_id, coalesce(l.turns[1:h.h], []) || coalesce(h.turns[h.h + 1:], []) AS turns
    FROM h LEFT JOIN l ON l.conv_id = h.conv_id - h.conv_id % 5),
  p AS (
    SELECT conv_id, list_transform(turns, lambda x: x.g) AS gs, list_transform(turns, lambda x: x.b) AS bs,
           len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth FROM r),
  n AS (
    SELECT depth, array_to_string(gs[1:depth], '') AS path, coalesce(min(bs[depth]), 0) AS b, min(conv_id) AS conv_id,
           count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
    FROM p GROUP BY ALL),
  k AS (
    SELECT n.*, up.conv_id AS parent_conv_id, count(down.path) AS n_children
    FROM n LEFT JOIN n up ON up.depth = n.depth - 1 AND up.path = left(n.path, 32 * (n.depth - 1))
           LEFT JOIN n down ON down.depth = n.depth + 1 AND left(down.path, 32 * n.depth) = n.path
    GROUP BY ALL),
  s AS (SELECT left(path, 32 * d) AS path, n_children = 0 AS leaf, (n_convs - 1) * b AS saved
        FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM k)),
  a AS (SELECT path, CAST(count_if(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM s GROUP BY path)
  SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM k JOIN a USING (path)""")
def op12(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.prefix_trie(prefix_trie.share_heads(prefix_trie.turn_lists(turns)))


@query("op13_personal_data")
def op13(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return personal.find_personal_data(docs, personal.fit(docs))
