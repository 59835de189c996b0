"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import (
    collocations,
    doc_fingerprints,
    exact_dedup,
    hard_negatives,
    mixing,
    packing,
    ppm,
    secret_scan,
    simhash_dedup,
    token_files,
    tokens,
    tool_calls,
    toxicity,
    unigrams,
    url_filter,
)
from lexmill.llm.common import LOWER, UPPER, staged
from lexmill.llm.tool_calls import Argument
from lexmill.llm.url_filter import Rule
from lexmill.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_dedup(spark, sf_dir):
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op2_token_files(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokens.vocabulary_path("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, path)


def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_doc_fingerprints(spark, sf_dir):
    """The block tables answer for every row whose id is divisible by 50, against all rows."""
    rows = staged(doc_fingerprints.compared(table(spark, sf_dir, "documents")), "compared-documents")
    found = doc_fingerprints.searched(rows, F.col("doc_id") % 50 == 0)
    digits = doc_fingerprints.hex_digits
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digits("high", "low").alias("fingerprint"),
        digits("edited_high", "edited_low").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "rows_near",
        "first_near",
    )


URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def op5_url_filter(spark, sf_dir):
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, model)


def op6_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokens.vocabulary_path("word_bpe_49k.json"))


def op7_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op8_mixing(spark, sf_dir):
    sizes = mixing.sizes_of(table(spark, sf_dir, "documents"))
    taken = F.col("size") * F.col("copies")
    return mixing.copies_of(sizes, sizes).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


TOOLS = [
    Argument("search", "text", "STRING", max_length=400),
    Argument("search", "limit", "BIGINT"),
    Argument("translate", "text", "STRING"),
    Argument("translate", "to", "STRING"),
    Argument("summarise", "text", "STRING"),
    Argument("summarise", "limit", "BIGINT", required=False),
]


def tool_messages(talk: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conversations as tool traffic: a user's turn is a call that needs the result of the
    user's turn before it, the assistant's next turn its result, any other turn plain text."""
    name = lambda turn: F.concat(F.lit("call_"), turn.cast("string"))
    conv, turn, text = F.col("conv_id"), F.col("turn"), F.col("text")
    tool = F.get(F.array(F.lit("search"), F.lit("translate"), F.lit("summarise")), F.pmod(turn, F.lit(3)).cast("int"))
    arguments = (
        F.when(tool == "search", F.to_json(F.struct("text", F.pmod(conv, F.lit(7)).alias("limit"))))
        .when(tool == "translate", F.to_json(F.struct(F.when(conv % 5 != 0, F.lit("en")).alias("to"), "text")))
        .when(conv % 4 == 0, F.to_json(F.struct("text", F.lit("7").alias("limit"))))
        .otherwise(F.to_json(F.struct("text", F.lit(7).alias("limit"))))
    )
    calls = talk.where("role = 'user'").select(
        "conv_id", "turn", name(turn).alias("call_id"), name(turn - 2).alias("after"), tool.alias("tool"), arguments.alias("arguments")
    )
    results = talk.where("role = 'assistant'").select("conv_id", "turn", name(turn - 1).alias("call_id"), text.alias("content"))
    others = talk.where("role is null or role not in ('user', 'assistant')")
    return calls, results, others.select("conv_id", "turn", "role", text.alias("content"))


def op10_tool_calls(spark, sf_dir):
    return tool_calls.link(*tool_messages(table(spark, sf_dir, "conversations")), TOOLS)


def op11_hard_negatives(spark, sf_dir):
    vectors = hard_negatives.usable(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_lm_scores(spark, sf_dir):
    """PPM and smoothed word probabilities, learnt from the texts whose hashed id leaves no 1."""
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER).cast("binary")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    docs = table(spark, sf_dir, "documents").select("doc_id", (fold == 1).alias("held_out"), text.alias("text"))
    model = ppm.train(docs.where("not held_out").select("text"))
    docs = docs.withColumn("training", ~F.col("held_out"))
    at_once = ppm.scorer(model)
    scored = unigrams.scored(docs, at_once) if at_once else unigrams.scored(docs, pieces=ppm.Pieces(model))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_dedup,
        op2_token_files,
        op3_toxicity,
        op4_doc_fingerprints,
        op5_url_filter,
        op6_packing,
        op7_secret_scan,
        op8_mixing,
        op9_exact_dedup,
        op10_tool_calls,
        op11_hard_negatives,
        op12_lm_scores,
        op13_collocations,
    )
}

SQL = {
    "op8_mixing": r"""
      WITH sizes AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint AS size
                     FROM documents),
      per AS (SELECT source, sum(size)::bigint AS source_size,
                     [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::integer]::bigint AS weight
              FROM sizes GROUP BY source),
      lim AS (SELECT *, 3 * source_size AS lim, (3 * source_size)::double / weight AS fullness FROM per),
      rise AS (SELECT DISTINCT fullness,
                      sum(source_size) OVER ()
                        - coalesce(sum(lim) OVER (ORDER BY fullness RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
                                                  EXCLUDE GROUP), 0) AS rest,
                      sum(weight) OVER ()
                        - coalesce(sum(weight) OVER (ORDER BY fullness RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
                                                     EXCLUDE GROUP), 0) AS share
               FROM lim),
      lev AS (SELECT rest::double AS rest, share::double AS share FROM rise WHERE rest::double / share <= fullness
              ORDER BY fullness LIMIT 1),
      tgt AS (SELECT source, source_size, least(lim::double, rest * weight / share) AS target FROM lim, lev),
      rated AS (SELECT doc_id, size, source_size, target,
                       CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
                       ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint::double
                         / 4503599627370496 AS u
                FROM sizes JOIN tgt ON sizes.source IS NOT DISTINCT FROM tgt.source)
      SELECT doc_id, size, source_size, target,
             size * (floor(rate)::bigint + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
      FROM rated""",
    "op9_exact_dedup": """
      WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
                 FROM documents)
      SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
             doc_id = max(doc_id) OVER g AS kept, text_sha256
      FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op10_tool_calls": """
      WITH u AS (SELECT *, ['search', 'translate', 'summarise'][(turn % 3 + 1)::integer] AS tool
                 FROM conversations WHERE role = 'user'),
      a AS (SELECT * FROM conversations WHERE role = 'assistant'),
      chain AS (SELECT *, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island FROM u),
      deep AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS depth FROM chain),
      said AS (SELECT conv_id, turn, 'call_' || turn AS call_id, 'call' AS kind,
                      CASE WHEN EXISTS (SELECT 1 FROM a WHERE a.conv_id = deep.conv_id AND a.turn = deep.turn + 1)
                           THEN 'answered' ELSE 'unanswered' END AS status,
                      CASE tool WHEN 'search' THEN CASE WHEN length(text) > 400 THEN 'length of text' ELSE '' END
                                WHEN 'translate' THEN CASE WHEN conv_id % 5 = 0 THEN 'missing to' ELSE '' END
                                ELSE CASE WHEN conv_id % 4 = 0 THEN 'type of limit' ELSE '' END END AS errors,
                      2 * depth AS step,
                      '{"arguments":{' ||
                        CASE tool WHEN 'search' THEN '"limit":' || conv_id % 7 || ',"text":' || to_json(text)::varchar
                                  WHEN 'translate' THEN '"text":' || to_json(text)::varchar
                                                        || CASE WHEN conv_id % 5 = 0 THEN '' ELSE ',"to":"en"' END
                                  ELSE '"limit":' || CASE WHEN conv_id % 4 = 0 THEN '"7"' ELSE '7' END
                                       || ',"text":' || to_json(text)::varchar END
                        || '},"id":"call_' || turn || '","kind":"call","tool":"' || tool || '"}' AS message
               FROM deep),
      got AS (SELECT a.conv_id, a.turn, 'call_' || (a.turn - 1) AS call_id, 'result' AS kind,
                     CASE WHEN d.turn IS NULL THEN 'orphan' ELSE 'linked' END AS status, NULL::varchar AS errors,
                     2 * d.depth + 1 AS step,
                     '{"content":' || to_json(a.text)::varchar || ',"id":"call_' || (a.turn - 1) || '","kind":"result"}' AS message
              FROM a LEFT JOIN deep d ON d.conv_id = a.conv_id AND d.turn = a.turn - 1),
      other AS (SELECT conv_id, turn, NULL::varchar AS call_id, 'text' AS kind, NULL::varchar AS status,
                       NULL::varchar AS errors, -1 AS step,
                       '{"content":' || to_json(text)::varchar || ',"kind":"text","role":"' || role || '"}' AS message
                FROM conversations WHERE role NOT IN ('user', 'assistant'))
      SELECT * FROM said UNION ALL SELECT * FROM got UNION ALL SELECT * FROM other""",
    "op11_hard_negatives": """
      WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                        list_transform(embedding, lambda x: floor(256 * x::double)) AS v
                 FROM embeddings
                 WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
                   list_dot_product(a.v, b.v)::bigint AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
      p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
      SELECT anchor_id, positive_id,
             (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::integer AS rank,
             vec_id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
      QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3""",
    "op13_collocations": r"""
      WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                             unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                                    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
                      FROM documents),
      w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
      n AS (SELECT lang, sum(len(w))::bigint AS n FROM w GROUP BY lang),
      places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
      f AS (SELECT lang, w[i:i + m - 1] AS ws, count(*)::bigint AS f
            FROM places, (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(w) GROUP BY ALL),
      c AS (SELECT lang, ws, f AS a FROM f WHERE len(ws) > 1 AND f >= 100),
      inside AS (SELECT lang, ws[i:j] AS ws, max(a) AS longest
                 FROM (SELECT lang, ws, a, i, unnest(range(i + 1, len(ws) + 1)) AS j
                       FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM c))
                 WHERE j - i + 1 < len(ws) GROUP BY ALL),
      kept AS (SELECT c.* FROM c LEFT JOIN inside USING (lang, ws) WHERE longest IS NULL OR 100 * longest < 100 * a),
      cuts AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS k FROM kept),
      scored AS (SELECT cuts.lang, cuts.ws, a, k, x.f AS l, y.f AS r, n,
                        ((1000::hugeint * a * n) // (x.f::hugeint * y.f))::bigint AS score
                 FROM cuts JOIN n ON n.lang = cuts.lang
                 JOIN f x ON x.lang = cuts.lang AND x.ws = cuts.ws[1:k]
                 JOIN f y ON y.lang = cuts.lang AND y.ws = cuts.ws[k + 1:]),
      low AS (SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, n, score FROM scored
              QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1)
      SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
             phrase, a, l, r, n, score
      FROM low QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000""",
}
