"""The registered queries of the text operators, over whole tables, each beside its SQL where SQL can express it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    best_fit, chat_format, decontaminate, license_scan, line_dedup, periodic_runs, quality_model, quality_rules, simhash, suffix_dedup,
    token_alignment, token_packing, url_rules,
)
from starmart.llm.common import hex_of, ready, stage_table, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# fixed values: the rules that pages are judged by
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        @functools.wraps(run)
        def started(spark: SparkSession, sf_dir: str) -> DataFrame:
            ready(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = started
        if sql:
            SQL[run.__name__] = sql
        return started

    return register


@query(
    f"""
    WITH lines AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             unnest(string_split({ASCII_LOWER}, chr(10))) AS low,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
      FROM documents),
    keyed AS (SELECT *, trim(low, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM lines),
    repeated AS (
      SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keeper <> doc_id) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
    FROM keyed LEFT JOIN repeated USING (key) GROUP BY doc_id
    """
)
def op1_line_dedup(spark, sf_dir):
    docs = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op2_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, quality_model.graded(table(spark, sf_dir, "labels")))
    return quality_model.score(docs, model).select("doc_id", "expected_grade", "tail_probability", "kept")


@query()
def op3_token_output(spark, sf_dir):
    return token_packing.pack_tokens(table(spark, sf_dir, "documents"))


@query()
def op4_best_fit_packing(spark, sf_dir):
    docs = simhash.with_components(table(spark, sf_dir, "documents"), "cluster")
    return best_fit.best_fit_bins(docs, cluster="cluster")


@query(
    r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (
      SELECT item_id, regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    sizes AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
    wins AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
             FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sizes)),
    shapes AS (SELECT DISTINCT n FROM wins),
    starts AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
               FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, shapes)),
    found AS (SELECT doc_id, item_id, i, n FROM starts JOIN wins USING (n, win)),
    hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS all_items
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(all_items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """.replace("{low}", ASCII_LOWER)
)
def op5_decontamination(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(
    r"""
    WITH rules(rule_host, rule_path, verdict) AS (VALUES {rules}),
    rest AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (
      SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    best AS (
      SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
             arg_max(verdict, length(rule_host || rule_path)) AS verdict
      FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)
    """.replace("{rules}", ", ".join(map(str, RULES)))
)
def op6_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


@query(
    r"""
    WITH t(license_id, text) AS (VALUES {templates}),
    tw AS (SELECT license_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM t),
    ts AS (SELECT DISTINCT license_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT license_id, w, unnest(range(1, len(w) - 3)) AS i FROM tw)),
    dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
    ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM dw)),
    n AS (SELECT license_id, count(*) AS n FROM ts GROUP BY license_id),
    hits AS (SELECT doc_id, license_id, count(*) AS m FROM ds JOIN ts USING (s) GROUP BY doc_id, license_id)
    SELECT doc_id, license_id, m::DOUBLE / n AS containment FROM hits JOIN n USING (license_id) WHERE m::DOUBLE / n >= 0.8
    """.replace("{templates}", ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in license_scan.TEMPLATES.items()))
)
def op7_license_scans(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.template_table(spark))


@query()
def op8_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))


@query()
def op9_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    judged = quality_rules.judge(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query()
def op10_simhash_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_of(F.col("fingerprint")).alias("fingerprint"), "component_id")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, every tenth document (by the checksum of its id) going on with a period from some word on."""
    words = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h")).withColumns(
        {"g": F.floor(F.col("h") / 10), "w": F.when(F.col("h") % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))}
    )
    words = words.withColumns({"n": F.size("w"), "a": F.when(F.size("w") > 0, F.col("g") % F.size("w")).cast("int")})
    words = words.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    left = F.col("n") - F.col("a")
    block = F.slice("w", F.col("a") + 1, F.col("p"))
    again = F.slice(F.flatten(F.array_repeat(block, F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    planted = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a")), again)
    return words.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


@query()
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    # runs come by start, then period, so only a greater exponent takes the place of an earlier one
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op12_token_alignment(spark, sf_dir):
    aligned = stage_table(token_alignment.align(table(spark, sf_dir, "documents")), "aligned")
    counts = stage_table(token_alignment.link_counts(aligned, token_alignment.piece_ids()), "link_counts")
    n_links = F.size("links").cast("bigint")
    return token_alignment.with_counts(aligned, counts).select(
        "doc_id", "n_a", "n_b", n_links.alias("n_groups"), n_links.alias("n_links"), "n_best", "count_sum",
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
    )


# fixed value: what both turns of the added conversation say
CONTROL_TEXT = "\\### Assistant: </turn> ok"


@query(
    r"""
    WITH said AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '{control}' UNION ALL SELECT -7, 1, 'assistant', '{control}'),
    sized AS (
      SELECT *, length(text) + (length(text) - length(replace(text, chr(92), ''))) + (length(text) - length(replace(text, '### ', ''))) // 4
             + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS body FROM said)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(length('### ' || role || ': ' || '</turn>' || chr(10)) + body)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id
    """.replace("{control}", CONTROL_TEXT)
)
def op13_chat_formatting(spark, sf_dir):
    added = [{"role": r, "content": CONTROL_TEXT} for r in ("user", "assistant")]
    added = spark.createDataFrame([(-7, added)], "conv_id bigint, messages array<struct<role:string,content:string>>")
    turns = chat_format.canonical(table(spark, sf_dir, "conversations")).unionByName(chat_format.canonical(added))
    read = chat_format.read_back(chat_format.format_turns(turns))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss", "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
