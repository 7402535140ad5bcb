"""Query catalogue: each query reads the driver tables at ``sf_dir`` and
composes library operators; next to it sits the equivalent SQL (DuckDB
dialect) used as the correctness oracle.

Conventions shared by both sides: doubles rounded to 6 places, counts
bigint, 0/1 flags int, every computed column aliased to the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurejudge.functions import text as tx
from featurejudge.functions.columns import (col_or_default, features_excluding, keep_primary,
                                            resolve_column, rounded, safe_number, select_available)
from featurejudge.operators import encode, joins
from featurejudge.operators.rank import conditional_rates, flag_impact
from featurejudge.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# caller vocabularies (literal terms: "licen[sc]e|copyright|permission" and
# "gear|gizmo" written as term lists, so they take the substring path)
LICENSE_PATTERN = ("licence", "license", "copyright", "permission")
GEAR_PATTERN = ("gear", "gizmo")


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def sql_flag(col: str, terms, word: bool = False) -> str:
    pattern = tx.keyword_pattern(terms, word).replace("'", "''")
    return f"CAST(coalesce(regexp_matches({col}, '{pattern}', 'i'), false) AS INTEGER)"


def r6(col: str) -> str:
    return f"round(CAST({col} AS DOUBLE), 6)"


# ---------------------------------------------------------------------------
# text flags
# ---------------------------------------------------------------------------

DOC_FLAGS = {"supply_cut": tx.SUPPLY_V2, "naval_power": tx.NAVAL_THEORY, "license_terms": LICENSE_PATTERN}


def flagged_documents(spark, sf, flags=DOC_FLAGS) -> DataFrame:
    """documents with keyword flags, text dropped before any shuffle."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return tx.with_keyword_flags(docs, "text", flags).drop("text")


def _flag_impact_sql() -> str:
    flags = "".join(f", {sql_flag('text', t)} AS {n}" for n, t in DOC_FLAGS.items())
    aggs = "".join(f", sum({n}) AS s_{n}, avg(CASE WHEN {n} = 1 THEN quality END) AS r_{n}" for n in DOC_FLAGS)
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS flag, CAST(n AS BIGINT) AS n_rows, CAST(coalesce(s_{n}, 0) AS BIGINT) AS n_flagged, "
        f"{r6(f's_{n} / n')} AS prevalence, {r6(f'r_{n}')} AS outcome_rate, "
        f"printf('%.1f%%', round(s_{n} / n * 100, 1)) AS prevalence_pct FROM agg" for n in DOC_FLAGS)
    return (f"WITH d AS (SELECT doc_id{flags} FROM documents), "
            f"j AS (SELECT d.*, l.quality FROM d LEFT JOIN labels l ON d.doc_id = l.doc_id), "
            f"agg AS (SELECT count(*) AS n{aggs} FROM j) {rows}")


@query("flag_impact_text", _flag_impact_sql())
def flag_impact_text(spark: SparkSession, sf: str) -> DataFrame:
    d = flagged_documents(spark, sf)
    j = d.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    out = flag_impact(j, list(DOC_FLAGS), "quality")
    return out.withColumns({"prevalence": rounded("prevalence"), "outcome_rate": rounded("outcome_rate")})


PART_FLAGS = {"supply_cut": tx.SUPPLY_V2, "naval_power": tx.NAVAL_THEORY,
              "small_part": "small", "gear_part": GEAR_PATTERN}


PART_NAME_SQL = "coalesce(p_name, 'Unknown')"


@query("keyword_flags_parts",
       "SELECT p_partkey, coalesce(p_name, 'Unknown') AS name"
       + "".join(f", {sql_flag(PART_NAME_SQL, t)} AS {n}" for n, t in PART_FLAGS.items())
       + f", {sql_flag(PART_NAME_SQL, tx.SUPPLY_V2, word=True)} AS supply_cut_word"
       + " FROM part")
def keyword_flags_parts(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", tx.text_or_default("p_name", tx.UNKNOWN).alias("name"))
    p = tx.with_keyword_flags(p, "name", PART_FLAGS)
    return p.withColumn("supply_cut_word", tx.keyword_flag("name", tx.SUPPLY_V2, word=True))


@query("attach_text_by_key",
       "WITH pf AS (SELECT p_partkey, p_name, "
       f"{sql_flag('p_name', tx.SUPPLY_V2)} AS supply_cut, {sql_flag('p_name', 'small')} AS small_part FROM part) "
       "SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, pf.p_name, pf.supply_cut, pf.small_part "
       "FROM lineitem l LEFT JOIN pf ON l.l_partkey = pf.p_partkey")
def attach_text_by_key(spark, sf):
    # flags are computed once per part, then attached to lines by key
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    parts = tx.with_keyword_flags(parts, "p_name", {"supply_cut": tx.SUPPLY_V2, "small_part": "small"})
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(parts, "l_partkey", "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_name", "supply_cut", "small_part")


@query("feature_subset",
       "SELECT o_orderkey AS key, o_totalprice, o_custkey, CAST(1.0 AS DOUBLE) AS force_ratio, "
       "0 AS o_discount FROM orders")
def feature_subset(spark, sf):
    o = table(spark, sf, "orders")
    key = resolve_column(o, ["ISQNO", "O_ORDERKEY"], required=True)
    features = [c for c in features_excluding(o, [key, "o_orderstatus", "o_orderdate", "o_orderpriority"])]
    wanted = select_available(o, ["o_totalprice", "o_custkey", "o_shippriority"])
    assert set(wanted) <= set(features)
    return o.select(F.col(key).alias("key"), *wanted,
                    F.lit(1.0).alias("force_ratio"),
                    col_or_default(o, "o_discount", 0).alias("o_discount"))


def _four_vocab_sql() -> str:
    flags, aggs, rows = [], [], []
    for vname, kinds in tx.VOCABULARIES.items():
        for kind, terms in kinds.items():
            n = f"{kind}_{vname}"
            flags.append(f"{sql_flag('text', terms)} AS {n}")
            aggs.append(f"sum({n}) AS s_{n}")
            rows.append(f"SELECT '{vname}' AS vocabulary, '{kind}' AS kind, CAST(s_{n} AS BIGINT) AS n_flagged, "
                        f"{r6(f's_{n} / n')} AS prevalence FROM agg")
    return (f"WITH d AS (SELECT {', '.join(flags)} FROM documents), "
            f"agg AS (SELECT count(*) AS n, {', '.join(aggs)} FROM d) " + " UNION ALL ".join(rows))


@query("keyword_flags_four_vocabularies", _four_vocab_sql())
def keyword_flags_four_vocabularies(spark, sf):
    flags = {f"{kind}_{v}": terms for v, kinds in tx.VOCABULARIES.items() for kind, terms in kinds.items()}
    d = tx.with_keyword_flags(table(spark, sf, "documents").select("text"), "text", flags)
    one = d.agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(f"s_{n}") for n in flags])
    rows = [F.struct(F.lit(v).alias("vocabulary"), F.lit(k).alias("kind"),
                     F.col(f"s_{k}_{v}").cast("long").alias("n_flagged"),
                     rounded(F.col(f"s_{k}_{v}") / F.col("n")).alias("prevalence"))
            for v, kinds in tx.VOCABULARIES.items() for k in kinds]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query("conditional_outcome_rate",
       f"WITH d AS (SELECT doc_id, lang, {sql_flag('text', tx.SUPPLY_V2)} AS supply_cut FROM documents), "
       "j AS (SELECT d.*, l.quality, l.toxic FROM d LEFT JOIN labels l ON d.doc_id = l.doc_id) "
       "SELECT lang, count(*) AS n_rows, CAST(sum(supply_cut) AS BIGINT) AS n_flagged, "
       "count(quality) AS n_quality, "
       f"{r6('avg(CASE WHEN supply_cut = 1 THEN quality END)')} AS quality_rate_flag1, "
       f"{r6('avg(CASE WHEN supply_cut = 0 THEN quality END)')} AS quality_rate_flag0, "
       "count(toxic) AS n_toxic, "
       f"{r6('avg(CASE WHEN supply_cut = 1 THEN toxic END)')} AS toxic_rate_flag1, "
       f"{r6('avg(CASE WHEN supply_cut = 0 THEN toxic END)')} AS toxic_rate_flag0 "
       "FROM j GROUP BY lang")
def conditional_outcome_rate(spark, sf):
    d = flagged_documents(spark, sf, {"supply_cut": tx.SUPPLY_V2})
    j = d.join(table(spark, sf, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    out = conditional_rates(j, "supply_cut", ["quality", "toxic"], by=["lang"])
    return out.withColumns({c: rounded(c) for c in out.columns if "_rate_" in c})


# ---------------------------------------------------------------------------
# detail joins and lookups
# ---------------------------------------------------------------------------

def primary_lines(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem").withColumn("primary", (F.col("l_linenumber") == 1).cast("int"))
    return keep_primary(li, "primary")


@query("primary_detail_left_join",
       "SELECT o.o_orderkey, o.o_orderstatus, l.l_returnflag AS direction, l.l_quantity AS duration_days "
       "FROM orders o LEFT JOIN (SELECT * FROM lineitem WHERE l_linenumber = 1) l ON o.o_orderkey = l.l_orderkey")
def primary_detail_left_join(spark, sf):
    fact = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return joins.attach_detail(fact, primary_lines(spark, sf), "o_orderkey", ["l_returnflag", "l_quantity"],
                               rename={"l_returnflag": "direction", "l_quantity": "duration_days"},
                               dedupe="fanout", detail_key="l_orderkey")


LINE_TOTAL_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                    "l_returnflag", "l_linestatus", "l_shipdate"]


@query("primary_detail_dedup",
       "SELECT o.o_orderkey, o.o_orderstatus, l.l_returnflag AS direction, l.l_quantity AS duration_days "
       "FROM orders o LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY "
       + ", ".join(LINE_TOTAL_ORDER) + ") AS rn FROM lineitem WHERE l_linenumber = 1) WHERE rn = 1) l "
       "ON o.o_orderkey = l.l_orderkey")
def primary_detail_dedup(spark, sf):
    fact = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return joins.attach_detail(fact, primary_lines(spark, sf).select("l_orderkey", *LINE_TOTAL_ORDER),
                               "o_orderkey", ["l_returnflag", "l_quantity"],
                               rename={"l_returnflag": "direction", "l_quantity": "duration_days"},
                               dedupe="first", order_by=LINE_TOTAL_ORDER, detail_key="l_orderkey")


def nation_enum(spark, sf) -> DataFrame:
    """A code table with duplicate codes: nations (seq 1; those of regions
    above 2 without a description) and then the regions themselves (seq 2)
    under the same integer codes 0-4."""
    n = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("value"), F.when(F.col("n_regionkey") <= 2, F.col("n_name")).alias("description"),
        F.lit(1).alias("seq"))
    r = table(spark, sf, "region").select(
        F.col("r_regionkey").alias("value"), F.col("r_name").alias("description"), F.lit(2).alias("seq"))
    return n.unionByName(r)


@query("enum_lookup_default",
       "WITH enum AS (SELECT n_nationkey AS value, n_name AS description, 1 AS seq FROM nation "
       "WHERE n_regionkey IN (0, 1, 2) UNION ALL SELECT r_regionkey, r_name, 2 FROM region), "
       "d AS (SELECT value, description FROM (SELECT *, row_number() OVER (PARTITION BY value "
       "ORDER BY seq DESC, description DESC) AS rn FROM enum) WHERE rn = 1) "
       "SELECT c.c_custkey, c.c_nationkey, coalesce(d.description, 'Unknown') AS nation_desc "
       "FROM customer c LEFT JOIN d ON c.c_nationkey = d.value")
def enum_lookup_default(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return joins.enum_lookup(cust, "c_nationkey", nation_enum(spark, sf), out_col="nation_desc",
                             default="Unknown", seq_col="seq")


@query("status_by_priority_wide",
       "SELECT o_orderpriority, " + ", ".join(f"CAST(sum(CASE WHEN o_orderstatus = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{v}"
                                              for v in "FOP") + " FROM orders GROUP BY o_orderpriority")
def status_by_priority_wide(spark, sf):
    long = (table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")))
    return encode.long_to_wide(long, ["o_orderpriority"], "o_orderstatus", "n", ["F", "O", "P"], prefix="n", default=0)


@query("self_join_fetch", "SELECT o_orderkey, o_orderpriority, 'NA' AS o_clerk FROM orders")
def self_join_fetch(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    o = joins.fetch_optional_column(o, "o_orderpriority", "NA")
    return joins.fetch_optional_column(o, "o_clerk", "NA")


# ---------------------------------------------------------------------------
# encodings
# ---------------------------------------------------------------------------

def line_codes(spark, sf) -> DataFrame:
    """Three repeated code slots per line; the third is padded and nullable."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_returnflag").alias("terra1"), F.col("l_linestatus").alias("terra2"),
        F.when(F.col("l_linenumber") >= 5, F.concat(F.lit(" "), F.col("l_returnflag"), F.lit(" "))).alias("terra3"))


TERRAIN_VOCAB_SQL = ["A", "F", "N", "O", "R"]


@query("terrain_presence",
       "WITH codes AS (SELECT l_orderkey, l_returnflag AS terra1, l_linestatus AS terra2, "
       "CASE WHEN l_linenumber >= 5 THEN ' ' || l_returnflag || ' ' END AS terra3 FROM lineitem), "
       "long AS (SELECT l_orderkey, trim(code) AS code FROM codes UNPIVOT (code FOR slot IN (terra1, terra2, terra3))), "
       "pres AS (SELECT l_orderkey, "
       + ", ".join(f"max(CASE WHEN code = '{v}' THEN 1 ELSE 0 END) AS terra_{v}" for v in TERRAIN_VOCAB_SQL)
       + " FROM long GROUP BY l_orderkey) SELECT o.o_orderkey, "
       + ", ".join(f"pres.terra_{v}" for v in TERRAIN_VOCAB_SQL)
       + " FROM orders o LEFT JOIN pres ON o.o_orderkey = pres.l_orderkey")
def terrain_presence(spark, sf):
    long = encode.unpivot_codes(line_codes(spark, sf), "l_orderkey", ["terra1", "terra2", "terra3"])
    vocab = encode.fitted_vocabulary(long, "code")
    pres = encode.presence_matrix(long, "l_orderkey", "code", vocab, "terra")
    fact = table(spark, sf, "orders").select("o_orderkey")
    return fact.join(pres.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")


EVENT_TYPES_SQL = ["click", "error", "purchase", "signup", "view"]


def event_attributes(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        "user_id", "event_type", F.when(F.col("value") >= 250, "high").otherwise("low").alias("band"))


@query("attribute_counts",
       "WITH e AS (SELECT user_id, event_type, CASE WHEN value >= 250 THEN 'high' ELSE 'low' END AS band "
       "FROM events), cnt AS (SELECT user_id, "
       + ", ".join(f"CAST(sum(CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS bel_event_type_{v}"
                   for v in EVENT_TYPES_SQL)
       + ", " + ", ".join(f"CAST(sum(CASE WHEN band = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS bel_band_{v}"
                          for v in ["high", "low"])
       + " FROM e GROUP BY user_id) SELECT c.c_custkey, cnt.* EXCLUDE (user_id) "
       "FROM customer c LEFT JOIN cnt ON c.c_custkey = cnt.user_id")
def attribute_counts(spark, sf):
    ev = event_attributes(spark, sf)
    vocabs = {"event_type": encode.fitted_vocabulary(ev, "event_type"), "band": ["high", "low"]}
    counts = encode.count_matrix(ev, "user_id", vocabs, prefix="bel")
    fact = table(spark, sf, "customer").select("c_custkey")
    return fact.join(counts.withColumnRenamed("user_id", "c_custkey"), "c_custkey", "left")


@query("distinct_count_flag",
       "WITH p AS (SELECT l_orderkey, count(DISTINCT l_linenumber) AS n_phases FROM lineitem GROUP BY l_orderkey) "
       "SELECT o.o_orderkey, CAST(p.n_phases AS BIGINT) AS n_phases, CAST(p.n_phases > 1 AS INTEGER) AS multi_phase "
       "FROM orders o LEFT JOIN p ON o.o_orderkey = p.l_orderkey")
def distinct_count_flag(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    flags = encode.distinct_count_flag(li, "o_orderkey", "l_linenumber", 1, "n_phases", "multi_phase")
    return table(spark, sf, "orders").select("o_orderkey").join(flags, "o_orderkey", "left")


@query("top10_first_token",
       "WITH d AS (SELECT doc_id, trim(split_part(text, ',', 1)) AS commander FROM documents), "
       "top AS (SELECT commander, count(*) AS n FROM d WHERE commander IS NOT NULL GROUP BY commander "
       "ORDER BY n DESC, commander ASC LIMIT 10), "
       "ranked AS (SELECT commander, CAST(row_number() OVER (ORDER BY n DESC, commander ASC) AS INTEGER) AS cmd_rank FROM top), "
       "c AS (SELECT d.doc_id, d.commander, r.cmd_rank, count(*) AS cmd_count FROM d JOIN ranked r "
       "ON d.commander = r.commander GROUP BY d.doc_id, d.commander, r.cmd_rank) "
       "SELECT documents.doc_id, c.commander, c.cmd_rank, CAST(coalesce(c.cmd_count, 0) AS BIGINT) AS cmd_count "
       "FROM documents LEFT JOIN c ON documents.doc_id = c.doc_id")
def top10_first_token(spark, sf):
    docs = table(spark, sf, "documents")
    cmd = docs.select("doc_id", tx.first_token("text", ",").alias("commander"))
    rows, top = encode.top_k_texts(cmd, "doc_id", "commander", 10)
    # the top-k table holds at most k = 10 rows
    kept = rows.join(F.broadcast(top.select("_h", "commander", F.col("rank").alias("cmd_rank"))), "_h")
    counts = kept.groupBy("doc_id", "commander", "cmd_rank").agg(F.count(F.lit(1)).alias("cmd_count"))
    return docs.select("doc_id").join(counts, "doc_id", "left").withColumn(
        "cmd_count", F.coalesce(F.col("cmd_count"), F.lit(0)).cast("long"))


@query("threshold_flag_abs",
       "WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM customer) "
       "SELECT c_custkey, round((c_acctbal - m) / sd, 6) AS z_acctbal, "
       "CAST(coalesce(abs((c_acctbal - m) / sd) > 1, false) AS INTEGER) AS surprise_binary FROM customer, s")
def threshold_flag_abs(spark, sf):
    from featurejudge.operators.fit import fit_moments, standardize
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("z_acctbal"))
    z = standardize(c, fit_moments(c, ["z_acctbal"]))
    return z.select("c_custkey", rounded("z_acctbal").alias("z_acctbal"),
                    encode.abs_threshold_flag("z_acctbal", 1).alias("surprise_binary"))


@query("log_duration",
       "WITH d AS (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey) "
       "SELECT o.o_orderkey, round(d.q, 6) AS duration_days, round(ln(1 + d.q), 6) AS log_duration "
       "FROM orders o LEFT JOIN d ON o.o_orderkey = d.l_orderkey")
def log_duration(spark, sf):
    d = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("duration_days"))
    out = table(spark, sf, "orders").select("o_orderkey").join(d, "o_orderkey", "left")
    return out.select("o_orderkey", rounded("duration_days").alias("duration_days"),
                      rounded(F.log1p("duration_days")).alias("log_duration"))


PRIORITIES_SQL = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("onehot_single",
       "SELECT o_orderkey, o_orderstatus, "
       + ", ".join(f"CASE WHEN o_orderpriority = '{v}' THEN 1 ELSE 0 END AS "
                   f"o_orderpriority_{v.replace('-', '_').replace(' ', '_')}" for v in PRIORITIES_SQL)
       + " FROM orders")
def onehot_single(spark, sf):
    o = table(spark, sf, "orders")
    vocab = encode.fitted_vocabulary(o, "o_orderpriority")
    o = o.drop("o_clerk", "o_orderdate", "o_totalprice", "o_custkey")
    return encode.one_hot(o, "o_orderpriority", vocab)


@query("safe_parse",
       "SELECT event_id, TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k_num, "
       "TRY_CAST(props AS DOUBLE) AS props_num, CAST(trunc(value) AS INTEGER) AS value_int FROM events")
def safe_parse(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", safe_number(F.regexp_extract("props", r"(\d+)", 1), "int").alias("k_num"),
                    safe_number("props", "double").alias("props_num"),
                    F.col("value").cast("int").alias("value_int"))


def _load_all() -> None:
    # query modules register themselves on import
    from featurejudge.plans import chain, composite, evaluation, fitted, ml, storage  # noqa: F401


def all_queries() -> dict:
    _load_all()
    return dict(QUERIES)


def all_oracle() -> dict:
    _load_all()
    return dict(ORACLE)
