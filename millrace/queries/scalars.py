"""Scalar functions, user functions and scripting."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from millrace.queries.registry import Tables, day, ntz, query, rnd


@query("fn_string", sql="""
SELECT c_custkey, lower(c_mktsegment) AS lo, upper(c_name) AS up, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS title, c_name || '/' || c_mktsegment AS joined,
 substr(c_name, 1, 8) AS head, split_part(c_name, '#', 1) AS before_mark, split_part(c_name, '#', 2) AS after_mark, lpad(c_custkey::VARCHAR, 8, '0') AS padded,
 contains(c_name, '00')::INT AS has_zero, regexp_replace(c_name, '[0-9]+', 'N', 'g') AS no_digits, regexp_extract(c_name, '([0-9]+)$', 1) AS digits, length(c_name) AS len FROM customer""")
def fn_string(t: Tables):
    n, s = F.col("c_name"), F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey", F.lower(s).alias("lo"), F.upper(n).alias("up"), F.initcap(s).alias("title"), F.concat_ws("/", n, s).alias("joined"),
        F.substring(n, 1, 8).alias("head"), F.substring_index(n, "#", 1).alias("before_mark"), F.split(n, "#")[1].alias("after_mark"),
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("padded"), F.contains(n, F.lit("00")).cast("int").alias("has_zero"),
        F.regexp_replace(n, "[0-9]+", "N").alias("no_digits"), F.regexp_extract(n, "([0-9]+)$", 1).alias("digits"), F.length(n).cast("long").alias("len"))


@query("fn_datetime", sql="""
SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS ymd, date_trunc('month', ts)::TIMESTAMP AS month_start, strftime(ts + INTERVAL 10 DAY, '%Y-%m-%d') AS plus_ten,
 strftime(ts - INTERVAL 10 DAY, '%Y-%m-%d') AS minus_ten, strftime(CAST(ts AS DATE) + INTERVAL 2 MONTH, '%Y-%m-%d') AS plus_months,
 date_diff('day', DATE '2023-12-25', CAST(ts AS DATE))::BIGINT AS days, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 60000000 AS minutes,
 epoch(ts)::BIGINT - CASE WHEN epoch(ts)::BIGINT > epoch(ts) THEN 1 ELSE 0 END AS unix_s, year(ts) AS y, month(ts) AS m, day(ts) AS d, ts + INTERVAL 90 MINUTE AS later,
 strftime(strptime(strftime(ts, '%m-%d-%Y %H:%M:%S'), '%m-%d-%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed FROM events""")
def fn_datetime(t: Tables):
    ts = F.col("ts")
    stamp = F.date_format(ts, "MM-dd-yyyy HH:mm:ss")
    return t.events.select(
        "event_id", F.date_format(ts, "yyyyMMdd").cast("int").alias("ymd"), ntz(F.date_trunc("month", ts)).alias("month_start"),
        day(F.date_add(F.to_date(ts), 10)).alias("plus_ten"), day(F.date_sub(F.to_date(ts), 10)).alias("minus_ten"),
        day(F.add_months(F.to_date(ts), 2)).alias("plus_months"), F.datediff(F.to_date(ts), F.lit("2023-12-25")).cast("long").alias("days"),
        F.timestamp_diff("MINUTE", F.lit("2024-01-01").cast("timestamp_ntz"), ts).alias("minutes"), F.unix_timestamp(ts).alias("unix_s"),
        F.year(ts).cast("long").alias("y"), F.month(ts).cast("long").alias("m"), F.dayofmonth(ts).cast("long").alias("d"),
        (ts + F.expr("INTERVAL 90 MINUTES")).alias("later"),
        F.date_format(F.try_to_timestamp(stamp, F.lit("MM-dd-yyyy HH:mm:ss")), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("fn_math", sql="""
SELECT c_custkey, abs(c_acctbal) AS a, round(c_acctbal, 1) AS r, ceil(c_acctbal)::BIGINT AS c, floor(c_acctbal)::BIGINT AS f, round(exp(c_acctbal / 10000), 8) AS e,
 round(ln(abs(c_acctbal) + 1), 8) AS l, round(log10(abs(c_acctbal) + 1), 8) AS l10, round(sqrt(abs(c_acctbal)), 8) AS s, round(power(c_acctbal / 1000, 2), 8) AS p,
 greatest(c_acctbal, 0) AS g, least(c_acctbal, 0) AS le, round(sin(c_custkey), 8) AS si, round(cos(c_custkey), 8) AS co, c_custkey % 7 AS md FROM customer""")
def fn_math(t: Tables):
    b, k = F.col("c_acctbal"), F.col("c_custkey")
    return t.customer.select(
        "c_custkey", F.abs(b).alias("a"), F.round(b, 1).alias("r"), F.ceil(b).alias("c"), F.floor(b).alias("f"), rnd(F.exp(b / 10000), 8).alias("e"),
        rnd(F.ln(F.abs(b) + 1), 8).alias("l"), rnd(F.log10(F.abs(b) + 1), 8).alias("l10"), rnd(F.sqrt(F.abs(b)), 8).alias("s"), rnd(F.pow(b / 1000, F.lit(2)), 8).alias("p"),
        F.greatest(b, F.lit(0.0)).alias("g"), F.least(b, F.lit(0.0)).alias("le"), rnd(F.sin(k.cast("double")), 8).alias("si"), rnd(F.cos(k.cast("double")), 8).alias("co"),
        (k % 7).alias("md"))


@query("fn_null_type", sql="""
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'none') AS state, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS prio, TRY_CAST(o_orderpriority AS INTEGER) AS bad,
 round(o_totalprice / nullif(o_orderkey % 5, 0), 6) AS ratio, (o_orderstatus = 'F')::INT AS done, 'bigint' AS kind FROM orders""")
def fn_null_type(t: Tables):
    return t.orders.select(
        "o_orderkey", F.nvl(F.nullif("o_orderstatus", F.lit("P")), F.lit("none")).alias("state"),
        F.split("o_orderpriority", "-")[0].try_cast("int").alias("prio"), F.col("o_orderpriority").try_cast("int").alias("bad"),
        rnd(F.try_divide("o_totalprice", F.col("o_orderkey") % 5), 6).alias("ratio"), (F.col("o_orderstatus") == "F").cast("boolean").cast("int").alias("done"),
        F.typeof("o_orderkey").alias("kind"))


@query("fn_array", sql="""
WITH a AS (SELECT c_custkey, string_split(c_name, '0') AS parts FROM customer)
SELECT c_custkey, len(parts) AS n, array_to_string(list_transform(parts, lambda x: upper(x)), '+') AS joined, list_contains(parts, '1')::INT AS has_one, parts[1] AS first,
 list_sum(generate_series(1, c_custkey % 6 + 1))::BIGINT AS triangle FROM a""")
def fn_array(t: Tables):
    parts = F.split("c_name", "0")
    seq = F.sequence(F.lit(1).cast("long"), F.col("c_custkey") % 6 + 1)
    return t.customer.select(
        "c_custkey", F.size(parts).cast("long").alias("n"), F.array_join(F.transform(parts, F.upper), "+").alias("joined"),
        F.array_contains(parts, "1").cast("int").alias("has_one"), F.element_at(parts, 1).alias("first"),
        F.aggregate(seq, F.lit(0).cast("long"), lambda a, x: a + x).alias("triangle"))


@query("fn_map_struct", sql="""
SELECT o_orderkey, o_orderstatus AS inner_status, o_totalprice AS inner_total, CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 2 END AS kept, o_orderpriority AS priority FROM orders""")
def fn_map_struct(t: Tables):
    low = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    m = F.map_filter(F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), low), lambda k, v: v.isNotNull())
    shaped = t.orders.select("o_orderkey", F.named_struct(F.lit("inner_status"), F.col("o_orderstatus"), F.lit("inner_total"), F.col("o_totalprice")).alias("st"),
                             m.alias("m"), "o_orderpriority")
    return shaped.select("o_orderkey", "st.*", F.size("m").alias("kept"), F.coalesce(F.col("m")["priority"], "o_orderpriority").alias("priority"))


@query("fn_json", sql="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_typed,
 CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_variant, '{"id":' || event_id || ',"type":"' || event_type || '"}' AS packed, 1 AS fields FROM events""")
def fn_json(t: Tables):
    v = F.parse_json("props")
    return t.events.select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.from_json("props", "k int")["k"].alias("k_typed"),
        F.variant_get(v, "$.k", "int").alias("k_variant"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("packed"),
        F.json_array_length(F.concat(F.lit("["), F.col("props"), F.lit("]"))).alias("fields"))


@query("fn_hash_mask", sql="""
SELECT c_custkey, sha1(c_name) AS s1, sha256(c_name) AS s2, md5(c_name) AS m5, regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS masked,
 c_name AS round_trip FROM customer""")
def fn_hash_mask(t: Tables):
    key = F.lit("0123456789abcdef")
    sealed = F.base64(F.aes_encrypt(F.col("c_name"), key, F.lit("GCM")))
    return t.customer.select(
        "c_custkey", F.sha1("c_name").alias("s1"), F.sha2("c_name", 256).alias("s2"), F.md5("c_name").alias("m5"), F.mask("c_name").alias("masked"),
        F.aes_decrypt(F.unbase64(sealed), key, F.lit("GCM")).cast("string").alias("round_trip"))


@query("scripted_sum", sql="SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def scripted_sum(t: Tables):
    # a variable set once, then one aggregate: the row-by-row loop of a script becomes a group-by
    spark = t.views("orders")
    spark.sql("DECLARE OR REPLACE VARIABLE least_total DOUBLE DEFAULT 0")
    spark.sql("SET VARIABLE least_total = 100000")
    floor = spark.sql("SELECT least_total AS v").first()["v"]
    return spark.sql("SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders WHERE o_totalprice > :floor GROUP BY 1", args={"floor": floor})


@query("scripted_loop", sql="""
WITH g AS (SELECT o_orderpriority AS priority, count(*) AS n, sum(o_totalprice) AS total, count(*) FILTER (WHERE o_orderstatus = 'P') AS parted FROM orders GROUP BY 1)
SELECT priority, n, round(total, 2) AS total, round(sum(total) OVER (ORDER BY priority ROWS UNBOUNDED PRECEDING), 2) AS so_far, CASE WHEN parted > 0 THEN round(n / parted, 6) END AS per_parted FROM g""")
def scripted_loop(t: Tables):
    """A block with a loop and a handler, run by Spark: the rows are aggregated first, the loop walks the few groups."""
    return t.views("orders").sql("""
BEGIN
  DECLARE so_far DOUBLE DEFAULT 0;
  DECLARE ratio DOUBLE;
  DECLARE lines ARRAY<STRUCT<priority: STRING, n: BIGINT, total: DOUBLE, so_far: DOUBLE, per_parted: DOUBLE>> DEFAULT array();
  FOR g AS SELECT o_orderpriority AS priority, count(*) AS n, sum(o_totalprice) AS total, count_if(o_orderstatus = 'P') AS parted FROM orders GROUP BY 1 ORDER BY 1 DO
    SET so_far = so_far + g.total;
    BEGIN
      DECLARE EXIT HANDLER FOR DIVIDE_BY_ZERO SET ratio = NULL;
      SET ratio = round(g.n / g.parted, 6);
    END;
    SET lines = array_append(lines, named_struct('priority', g.priority, 'n', g.n, 'total', round(g.total, 2), 'so_far', round(so_far, 2), 'per_parted', ratio));
  END FOR;
  SELECT inline(lines);
END""")


# ---------------------------------------------------------------- user functions


@query("udf_pandas", sql="SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 8) AS charge FROM lineitem")
def udf_pandas(t: Tables):
    @F.pandas_udf("double")
    def charge(price: pd.Series, discount: pd.Series, tax: pd.Series) -> pd.Series:
        return price * (1 - discount) * (1 + tax)

    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rnd(charge("l_extendedprice", "l_discount", "l_tax"), 8).alias("charge"))


@query("udf_iterator", sql="SELECT event_id, round(value * 1.25 + 3, 6) AS scaled FROM events")
def udf_iterator(t: Tables):
    @F.pandas_udf("double")
    def scaled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = {"gain": 1.25, "bias": 3.0}  # loaded once per task, then used for every batch
        for values in batches:
            yield values * model["gain"] + model["bias"]

    return t.events.select("event_id", rnd(scaled("value"), 6).alias("scaled"))


@query("udf_struct", sql="SELECT event_id, floor(value)::BIGINT AS whole, round(value - floor(value), 6) AS part FROM events")
def udf_struct(t: Tables):
    @F.pandas_udf("whole long, part double")
    def parts(v: pd.Series) -> pd.DataFrame:
        whole = v.floordiv(1).astype("int64")
        return pd.DataFrame({"whole": whole, "part": v - whole})

    return t.events.select("event_id", parts("value").alias("p")).select("event_id", "p.whole", rnd("p.part", 6).alias("part"))


@query("udf_grouped_map", sql="""
WITH d AS (SELECT event_type, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS x, sum(value) AS y FROM events GROUP BY 1, 2)
SELECT event_type, round(regr_slope(y, x), 4) AS slope, count(*) AS days FROM d GROUP BY 1""")
def udf_grouped_map(t: Tables):
    # groups are daily totals: their size is the number of days, whatever the table holds
    daily = t.events.groupBy("event_type", F.datediff(F.to_date("ts"), F.lit("2024-01-01")).cast("double").alias("x")).agg(F.sum("value").alias("y"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf["x"], pdf["y"]
        slope = ((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum()
        return pd.DataFrame({"event_type": [pdf["event_type"].iloc[0]], "slope": [slope], "days": [len(pdf)]})

    return daily.groupBy("event_type").applyInPandas(fit, "event_type string, slope double, days long").withColumn("slope", rnd("slope"))


@query("udf_map_partitions", sql="SELECT doc_id, length(text) AS chars, (n_chars = length(text))::INT AS agrees FROM documents")
def udf_map_partitions(t: Tables):
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            chars = b["text"].str.len()
            yield pd.DataFrame({"doc_id": b["doc_id"], "chars": chars, "agrees": (chars == b["n_chars"]).astype("int32")})

    return t.documents.select("doc_id", "text", "n_chars").mapInPandas(measure, "doc_id long, chars long, agrees int")


@query("udf_sql_scalar", sql="SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount)), 2) AS net FROM lineitem GROUP BY 1")
def udf_sql_scalar(t: Tables):
    spark = t.views("lineitem")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION net_price(price DOUBLE, discount DOUBLE) RETURNS DOUBLE RETURN price * (1 - discount)")
    return spark.sql("SELECT l_returnflag, round(sum(net_price(l_extendedprice, l_discount)), 2) AS net FROM lineitem GROUP BY l_returnflag")


@query("udtf_lookup", sql="SELECT c_custkey, n_name AS nation, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'")
def udtf_lookup(t: Tables):
    spark = t.views("customer", "nation")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION segment_customers(segment STRING)
        RETURNS TABLE (c_custkey BIGINT, nation STRING, c_acctbal DOUBLE)
        RETURN SELECT c.c_custkey, n.n_name, c.c_acctbal FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_mktsegment = segment""")
    return spark.sql("SELECT * FROM segment_customers('BUILDING')")


@query("udtf_agg", sql="SELECT year(o_orderdate)::INTEGER AS y, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'O' GROUP BY 1")
def udtf_agg(t: Tables):
    spark = t.views("orders")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION yearly_totals(state STRING) RETURNS TABLE (y INT, n BIGINT, total DOUBLE)
        RETURN SELECT year(o_orderdate), count(*), round(sum(o_totalprice), 2) FROM orders WHERE o_orderstatus = state GROUP BY year(o_orderdate)""")
    return spark.sql("SELECT * FROM yearly_totals('O')")


@query("udf_python_sql", sql="SELECT p_partkey, length(p_name) + p_size AS code FROM part")
def udf_python_sql(t: Tables):
    @F.pandas_udf("long")
    def part_code(name: pd.Series, size: pd.Series) -> pd.Series:
        return name.str.len() + size

    spark = t.views("part")
    spark.udf.register("part_code", part_code)
    return spark.sql("SELECT p_partkey, part_code(p_name, p_size) AS code FROM part")


@query("value_counts", sql="SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand")
def value_counts(t: Tables):
    import pyspark.pandas as ps

    ps.set_option("compute.default_index_type", "distributed")  # no job just to number the rows
    counts = t.part.pandas_api()["p_brand"].value_counts().to_frame("n").reset_index().to_spark()
    return counts.select(F.col("p_brand"), "n").orderBy(F.desc("n"), "p_brand")


@query("describe", sql="""
SELECT 'o_totalprice' AS col, count(*) AS n, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS sd, min(o_totalprice) AS lo,
 round(quantile_cont(o_totalprice, 0.25), 4) AS q25, round(median(o_totalprice), 4) AS q50, round(quantile_cont(o_totalprice, 0.75), 4) AS q75, max(o_totalprice) AS hi FROM orders""")
def describe(t: Tables):
    from millrace.operators.aggregates import exact_percentiles

    v, name = F.col("o_totalprice"), F.lit("o_totalprice").alias("col")
    moments = t.orders.agg(F.count("*").alias("n"), rnd(F.avg(v)).alias("mean"), rnd(F.stddev(v)).alias("sd"), F.min(v).alias("lo"), F.max(v).alias("hi"))
    marks = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    quart = exact_percentiles(t.orders, [], "o_totalprice", marks).select(name, *[rnd(q).alias(q) for q in marks])
    return moments.select("*", name).join(quart, "col")
