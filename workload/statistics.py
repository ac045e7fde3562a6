"""Ranks, quantiles, folds, metrics, rank correlation, reshaping and top-k."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.operators import association, attribution, features, metrics, models, quantiles, ranks, reshape, summaries
from tamarack.session import shared_folder, written
from tamarack.sources.stages import manifest, reuse_or_build, write_table
from tamarack.sources.tables import typed_csv
from workload.catalog import Tables, query

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
GIVEN = """
with given as (
    select l_orderkey, l_linestatus, l_returnflag, nullif(l_quantity, 7) as l_quantity, l_extendedprice, nullif(l_discount, 0.05) as l_discount, l_tax
    from lineitem)
"""


def _given(t: Tables) -> DataFrame:
    """Line items with some missing numbers."""
    return t.lineitem.withColumns({
        "l_quantity": F.nullif("l_quantity", F.lit(7.0)), "l_discount": F.nullif("l_discount", F.lit(0.05)),
    })


@query(GIVEN + "select * from (" + " union all ".join(
    f"select '{c}' as \"column\", round(median({c}), 6) as median from given" for c in MEASURES) + ")")
def exact_medians(t: Tables) -> DataFrame:
    medians = quantiles.exact_medians(_given(t), MEASURES)
    return medians.select("column", F.round("median", 6).alias("median"))


@query("""
with b as (select l_returnflag, count(*) as n, min(l_extendedprice) as lowest, quantile_cont(l_extendedprice, 0.25) as q1,
    quantile_cont(l_extendedprice, 0.5) as median, quantile_cont(l_extendedprice, 0.75) as q3, max(l_extendedprice) as highest
    from lineitem group by 1)
select l_returnflag, n, lowest, round(q1, 4) as q1, round(median, 4) as median, round(q3, 4) as q3, highest,
    min(l_extendedprice) filter (l_extendedprice >= q1 - 1.5 * (q3 - q1)) as whisker_low,
    max(l_extendedprice) filter (l_extendedprice <= q3 + 1.5 * (q3 - q1)) as whisker_high
from lineitem join b using (l_returnflag) group by all
""")
def box_by_class(t: Tables) -> DataFrame:
    boxes = association.box_summary(t.lineitem, "l_extendedprice", "l_returnflag")
    return boxes.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query("""
select l_extendedprice as value, count(*) as n, sum(count(*)) over (order by l_extendedprice) - (count(*) - 1) / 2.0 as avg_rank
from lineitem group by 1
""")
def average_ranks(t: Tables) -> DataFrame:
    return ranks.average_ranks(t.lineitem, "l_extendedprice")


def _rho_sql(table: str, x: str, y: str) -> str:
    return f"""
with r as (select rank() over (order by {x}) + (count(*) over (partition by {x}) - 1) / 2.0 as rx,
        rank() over (order by {y}) + (count(*) over (partition by {y}) - 1) / 2.0 as ry from {table})
select '{x}' as score, count(*) as n, round(corr(rx, ry), 8) as rho from r
"""


@query(_rho_sql("lineitem", "l_quantity", "l_extendedprice"))
def rank_correlation(t: Tables) -> DataFrame:
    found = association.spearman(t.lineitem, "l_quantity", "l_extendedprice", "l_quantity")
    return found.select("score", "n", F.round("rho", 8).alias("rho"))


@query(f"""
select score, n, rho from ({_rho_sql("(select quality, n_chars from labels join documents using (doc_id))", "quality", "n_chars")})
union all
select score, n, rho from ({_rho_sql("(select quality, length(source) as s from labels join documents using (doc_id))", "quality", "s").replace("'quality'", "'source'")})
""")
def outside_score_correlations(t: Tables) -> DataFrame:
    """One long row per score, against an ordinal label with many ties."""
    rows = t.labels.join(t.documents.withColumn("s", F.length("source")), "doc_id")
    found = association.correlations(rows, "quality", {"quality": "n_chars", "source": "s"})
    return found.select("score", "n", F.round("rho", 8).alias("rho"))


@query()
def correlation_p_values(t: Tables) -> DataFrame:
    """No SQL: DuckDB has no Student distribution. See ``correlation_p_of_few``."""
    return association.spearman(t.lineitem, "l_quantity", "l_extendedprice", "l_quantity")


@query("""
with ranked as (
    select l_orderkey, count(*) over (partition by l_orderkey) as n,
        rank() over (partition by l_orderkey order by l_quantity) + (count(*) over (partition by l_orderkey, l_quantity) - 1) / 2.0 as rx,
        rank() over (partition by l_orderkey order by l_extendedprice) + (count(*) over (partition by l_orderkey, l_extendedprice) - 1) / 2.0 as ry
    from lineitem),
rho as (
    select l_orderkey, n, case when n >= 3 and min(rx) < max(rx) and min(ry) < max(ry) then corr(rx, ry) end as rho
    from ranked group by l_orderkey, n)
select l_orderkey, n, round(rho, 8) as rho, case when rho is null then null
    when n = 4 then round(greatest(1 - abs(rho), 0), 6) when n = 3 then round(1 - 2 * asin(least(round(abs(rho), 12), 1)) / pi(), 6) end as p
from rho
""")
def correlation_p_of_few(t: Tables) -> DataFrame:
    """Of three rows and of four the p value has a closed form. One group per order."""
    found = association.correlations_by(t.lineitem, ["l_orderkey"], "l_quantity", "l_extendedprice")
    return found.select("l_orderkey", "n", F.round("rho", 8).alias("rho"), F.when(F.col("n").between(3, 4), F.round("p", 6)).alias("p"))


@query("select p_type as value, count(*) as n from part group by 1 order by 2 desc, 1 limit 1")
def most_frequent(t: Tables) -> DataFrame:
    return summaries.most_frequent(t.part.withColumnRenamed("p_type", "value"), "value")


@query("""
with c as (select o_orderpriority, count(*) as n from orders group by 1)
select o_orderpriority, n, round(sum(n) over () / (count(*) over () * n), 10) as weight from c
""")
def class_weights(t: Tables) -> DataFrame:
    weights = summaries.class_weights(t.orders, "o_orderpriority")
    return weights.withColumn("weight", F.round("weight", 10))


@query("""
select name as class, coalesce(n, 0) as n from (values ('F'), ('O'), ('P'), ('X')) as listed(name)
left join (select o_orderstatus, count(*) as n from orders group by 1) on name = o_orderstatus
""")
def counts_for_classes(t: Tables) -> DataFrame:
    return summaries.counts_for_classes(t.orders.withColumnRenamed("o_orderstatus", "class"), "class", ["F", "O", "P", "X"])


@query(GIVEN + """
, m as (select median(l_quantity) as q, median(l_extendedprice) as p, median(l_discount) as d from given),
f as (select l_orderkey, coalesce(l_quantity, q) as q, coalesce(l_extendedprice, p) as p, coalesce(l_discount, d) as d from given, m),
s as (select avg(q) as mq, stddev_pop(q) as sq, avg(p) as mp, stddev_pop(p) as sp, avg(d) as md, stddev_pop(d) as sd from f)
select l_orderkey, round(sum((q - mq) / sq), 5) as quantity, round(sum((p - mp) / sp), 5) as price, round(sum((d - md) / sd), 5) as discount
from f, s group by 1
""")
def preprocessed_numbers(t: Tables) -> DataFrame:
    """Median fill, mean and population deviation fitted on all rows, then applied."""
    given = _given(t)
    columns = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount"}
    fitted = features.numeric_statistics(given, list(columns.values()))
    ready = given.select("l_orderkey", *[features.scaled(c, *fitted[c]).alias(name) for name, c in columns.items()])
    return ready.groupBy("l_orderkey").agg(*[F.round(F.sum(name), 5).alias(name) for name in columns])


FOLD_SQL = """
with folded as (
    select o_orderkey, o_orderpriority, o_totalprice, o_orderstatus,
        cast((row_number() over (partition by o_orderpriority order by md5('42-' || o_orderkey), o_orderkey) - 1) % 5 as int) as fold
    from orders),
predicted as (
    select 'price bands' as model, fold, o_orderpriority as actual, case when o_totalprice < 100000 then '1-URGENT'
        when o_totalprice < 300000 then '2-HIGH' when o_totalprice < 400000 then '3-MEDIUM' else '5-LOW' end as predicted
    from folded
    union all
    select 'status', fold, o_orderpriority, case o_orderstatus when 'F' then '1-URGENT' when 'O' then '5-LOW' else '2-HIGH' end
    from folded)
"""


@query(FOLD_SQL + "select o_orderkey, fold from folded")
def stratified_folds(t: Tables) -> DataFrame:
    return ranks.stratified_folds(t.orders, "o_orderkey", "o_orderpriority").select("o_orderkey", "fold")


def predictions(t: Tables) -> DataFrame:
    """Two simple rules as classifiers; neither ever says "4-NOT SPECIFIED"."""
    folded = ranks.stratified_folds(t.orders, "o_orderkey", "o_orderpriority")
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    bands = F.when(price < 100000, "1-URGENT").when(price < 300000, "2-HIGH").when(price < 400000, "3-MEDIUM").otherwise("5-LOW")
    by_status = F.when(status == "F", "1-URGENT").when(status == "O", "5-LOW").otherwise("2-HIGH")
    guesses = F.array(
        F.struct(F.lit("price bands").alias("model"), bands.alias("predicted")), F.struct(F.lit("status").alias("model"), by_status.alias("predicted"))
    )
    return folded.select("fold", F.col("o_orderpriority").alias("actual"), F.inline(guesses))


REPORT_SQL = """
, classes as (select model, fold, actual as class from predicted union select model, fold, predicted from predicted),
per_class as (
    select c.model, c.fold, class, count(*) filter (actual = class and predicted = class) as hit,
        count(*) filter (actual = class) as support, count(*) filter (predicted = class) as guessed
    from classes c join predicted p on p.model = c.model and p.fold = c.fold group by all),
pooled as (
    select model, class, sum(support) as support,
        coalesce(sum(hit) / nullif(sum(guessed), 0), 0) as precision, coalesce(sum(hit) / nullif(sum(support), 0), 0) as recall,
        2 * sum(hit) / (sum(guessed) + sum(support)) as f1
    from per_class group by all)
"""


@query(FOLD_SQL + REPORT_SQL + """
select model, class, round(precision, 10) as precision, round(recall, 10) as recall, round(f1, 10) as f1, cast(support as bigint) as support from pooled
union all select model, 'macro avg', round(avg(precision), 10), round(avg(recall), 10), round(avg(f1), 10), cast(sum(support) as bigint) from pooled group by model
union all select model, 'weighted avg', round(sum(precision * support) / sum(support), 10), round(sum(recall * support) / sum(support), 10),
    round(sum(f1 * support) / sum(support), 10), cast(sum(support) as bigint) from pooled group by model
""")
def class_report(t: Tables) -> DataFrame:
    report = metrics.class_report(metrics.confusion_counts(predictions(t), ["model"]), ["model"])
    both = report.unionByName(metrics.averaged_report(report, ["model"]))
    return both.withColumns({m: F.round(m, 10) for m in ("precision", "recall", "f1")})


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
F1_SQL = ", ".join(
    f"max(round(f1, 10)) filter (class = '{c}') as \"f1_{c.replace(' ', '_')}\"" for c in PRIORITIES
)


@query(FOLD_SQL + REPORT_SQL + f"""
, fold_scores as (
    select model, fold, accuracy, macro_f1 from
        (select model, fold, avg((actual = predicted)::int) as accuracy from predicted group by all)
        join (select model, fold, avg(2 * hit / (guessed + support)) as macro_f1 from per_class group by all) using (model, fold))
select model, round(accuracy, 10) as accuracy, round(accuracy_mean, 10) as accuracy_mean, round(accuracy_std, 10) as accuracy_std,
    round(macro_f1, 10) as macro_f1, round(macro_f1_mean, 10) as macro_f1_mean, round(macro_f1_std, 10) as macro_f1_std,
    p.* exclude (model, macro_f1)
from (select model, avg((actual = predicted)::int) as accuracy from predicted group by 1)
join (select model, avg(accuracy) as accuracy_mean, stddev_pop(accuracy) as accuracy_std, avg(macro_f1) as macro_f1_mean,
    stddev_pop(macro_f1) as macro_f1_std from fold_scores group by 1) using (model)
join (select model, avg(f1) as macro_f1, {F1_SQL} from pooled group by 1) p using (model)
""")
def cross_validation_summary(t: Tables) -> DataFrame:
    summary = metrics.cv_summary(predictions(t), "model", "fold", PRIORITIES)
    return summary.select("model", *[F.round(c, 10).alias(c) for c in summary.columns if c != "model"])


@query(FOLD_SQL + "select model, fold, round(avg((actual = predicted)::int), 10) as accuracy from predicted group by 1, 2")
def accuracy_by_fold(t: Tables) -> DataFrame:
    by = ["model", "fold"]
    return metrics.accuracy(metrics.confusion_counts(predictions(t), by), by).withColumn("accuracy", F.round("accuracy", 10))


@query(FOLD_SQL + "select actual, " + ", ".join(f"count(*) filter (predicted = '{c}') as \"{c}\"" for c in PRIORITIES)
       + " from predicted where model = 'price bands' group by 1")
def confusion_matrix(t: Tables) -> DataFrame:
    counts = metrics.confusion_counts(predictions(t).filter("model = 'price bands'"), [])
    return metrics.confusion_matrix(counts, PRIORITIES)


@query("select measure, count(*) as n, round(sum(value), 2) as total from (" + " union all ".join(
    f"select '{c}' as measure, value from (select {'nullif(' + c + ', 7)' if c == 'l_quantity' else 'nullif(' + c + ', 0.05)' if c == 'l_discount' else c} as value from lineitem) where value is not null"
    for c in MEASURES) + ") group by 1")
def columns_to_rows(t: Tables) -> DataFrame:
    long = reshape.to_long(_given(t), ["l_orderkey"], MEASURES, "measure", "value")
    return long.groupBy("measure").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


DIMENSIONS = [f"d{i:02d}" for i in range(64)]


@query("""
with long as (select label, unnest(embedding) as v, generate_subscripts(embedding, 1) as d from embeddings)
select label, 'd' || lpad(cast(d - 1 as varchar), 2, '0') as feature, round(avg(abs(v::double)), 8) as mean_abs from long group by 1, 2
""")
def mean_absolute_by_class(t: Tables) -> DataFrame:
    """Embedding coordinates stand in for attributions: mean |value| per (class, feature), arrays to rows."""
    table = attribution.mean_absolute(t.embeddings, "embedding", ["label"])
    rows = reshape.class_arrays_to_rows(table, ["label"], "mean_abs", ["all"], DIMENSIONS, "mean_abs")
    return rows.select("label", "feature", F.round("mean_abs", 8).alias("mean_abs"))


OVERALL_SQL = """
with long as (select label, unnest(embedding) as v, 'd' || lpad(cast(generate_subscripts(embedding, 1) - 1 as varchar), 2, '0') as feature from embeddings),
per_class as (select label, feature, avg(abs(v::double)) as m from long group by 1, 2),
overall as (select feature, avg(m) as m from per_class group by 1)
"""


def _overall(t: Tables, rows: DataFrame) -> DataFrame:
    table = attribution.mean_absolute(rows, "embedding", ["label"])
    per_class = reshape.class_arrays_to_rows(table, ["label"], "mean_abs", ["all"], DIMENSIONS, "mean_abs_shap")
    return attribution.overall_importance(per_class)


@query(OVERALL_SQL + "select feature, round(m, 8) as mean_abs_shap from overall order by m desc, feature limit 8")
def top_features(t: Tables) -> DataFrame:
    best = attribution.top_features(_overall(t, t.embeddings), 8)
    return best.withColumn("mean_abs_shap", F.round("mean_abs_shap", 8))


@query("""
with long as (select label, label < 5 as low, unnest(embedding) as v, 'd' || lpad(cast(generate_subscripts(embedding, 1) - 1 as varchar), 2, '0') as feature from embeddings),
per_class as (select low, label, feature, avg(abs(v::double)) as m from long group by all),
overall as (select low, feature, avg(m) as m from per_class group by all),
ranked as (select *, rank() over (partition by low order by m desc) as r from overall)
select feature, round(max(m) filter (low), 8) as phase1, cast(max(r) filter (low) as int) as rank1,
    round(max(m) filter (not low), 8) as phase2, cast(max(r) filter (not low) as int) as rank2 from ranked group by 1
""")
def compare_importance(t: Tables) -> DataFrame:
    """Two tables side by side: the first five classes against the others."""
    first, second = (_overall(t, t.embeddings.filter(condition)) for condition in ("label < 5", "label >= 5"))
    both = attribution.compare_importance(first, second)
    return both.withColumns({c: F.round(c, 8) for c in ("phase1", "phase2")})


@query("""
select vec_id, list_position(embedding, list_max(embedding)) - 1 as place, round(list_max(embedding)::double, 6) as highest,
    'd' || lpad(cast(list_position(list_transform(embedding, lambda x: abs(x)), list_max(list_transform(embedding, lambda x: abs(x)))) - 1 as varchar), 2, '0') as top_feature
from embeddings
""")
def row_argmax(t: Tables) -> DataFrame:
    """Most probable place and its value, and the feature with the largest |value|."""
    place, _, highest = models.top_class(F.col("embedding"), DIMENSIONS)
    strongest = attribution.top_feature(F.col("embedding"), F.lit(0), DIMENSIONS)
    return t.embeddings.select("vec_id", place.alias("place"), F.round(highest.cast("double"), 6).alias("highest"), strongest.alias("top_feature"))


@query("select p_partkey, p_name, p_size, round(p_retailprice, 2) as p_retailprice from part")
def typed_reread(t: Tables) -> DataFrame:
    """A stage written as CSV and read back with a fixed schema."""
    path = f"{shared_folder(t.spark)}/part-{uuid.uuid4().hex}"
    write_table(t.part, path, "csv")
    return typed_csv(t.spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double")


@query("""
select request, o_orderpriority, count(*) as n from orders cross join (values ('first', 'FOP'), ('again', 'FOP'), ('changed', 'O')) r(request, statuses)
where contains(statuses, o_orderstatus) group by all
""")
def stage_reuse(t: Tables) -> DataFrame:
    """The same request finds the finished stage and does not build it again; one that changes an argument does."""
    path = f"{shared_folder(t.spark)}/counts-{uuid.uuid4().hex}"

    def request(name: str, statuses: str, rows: DataFrame) -> DataFrame:
        kept = rows.filter(F.col("o_orderstatus").isin(list(statuses)))
        stage = reuse_or_build(t.spark, path, lambda: summaries.value_counts(kept, ["o_orderpriority"]), manifest(orders=t.orders, statuses=statuses))
        return written(stage.select(F.lit(name).alias("request"), "o_orderpriority", "n"), "request")

    return request("first", "FOP", t.orders).unionAll(request("again", "FOP", t.orders.limit(0))).unionAll(request("changed", "O", t.orders))
