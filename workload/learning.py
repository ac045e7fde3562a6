"""Cross-validation, self-training, attributions and scoring on documents.

Stand-ins: labelled documents are the gold set, the others the pool; the class combines quality and toxicity. The
registered queries use few and shallow trees, with the published folds, rounds and threshold.
"""

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions import vocab
from tamarack.operators import metrics
from tamarack.operators.attribution import base_values, overall_importance, top_features
from tamarack.operators.features import class_index, class_weight, fit_preprocessor, preprocessor_of
from tamarack.operators.keys import unlabelled_pool
from tamarack.operators.models import ClassShares, logistic_gradient, logistic_regression
from tamarack.operators.scoring import explain, load_bundle, prediction_table, score
from tamarack.operators.selftrain import frequency_scorer, self_train
from tamarack.operators.summaries import coverage
from tamarack.operators.training import figures_of
from tamarack.plans.experiment import (
    Phases, Setting, attribution_table, compare_attributions, compare_models, compare_phases, final_bundle, model_predictions,
    train_iteratively, write_experiment,
)
from tamarack.session import shared_folder, written
from tamarack.sources.stages import write_table
from tamarack.sources.tables import scoring_input
from workload.catalog import Tables, query
from workload.statistics import REPORT_SQL

NUMERIC = ("n_chars", "n_words", "n_lines", "digit_share")
SETTING = Setting(
    row_id="doc_id", label="label", numeric=NUMERIC, categorical="lang", trees=12, depth=6, boost_rounds=3, boost_depth=3,
)
CLASSES = ["clean", "poor", "toxic"]


def document_features(documents: DataFrame) -> DataFrame:
    """Numbers over whole texts; one source has no line counts, so there is something to fill."""
    digits = F.length("text") - F.length(F.translate("text", "0123456789", ""))
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return documents.select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
        F.when(F.col("source") != "src0", lines).cast("double").alias("n_lines"),
        F.try_divide(digits, F.length("text")).alias("digit_share"),
    )


def gold_and_pool(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = document_features(t.documents)
    label = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").otherwise("clean")
    gold = rows.join(t.labels.select("doc_id", label.alias("label")), "doc_id")
    return gold, unlabelled_pool(rows, t.labels, ["doc_id"])


def _self_training_sql(rounds: int, threshold: float) -> str:
    """The loop written out round by round: class shares per language and per length band, averaged."""
    share = {c: ", ".join(f"count(*) filter (label = '{k}') / count(*) as {c}_{k}" for k in CLASSES) for c in ("lang", "band")}
    mean = {k: f"(coalesce(lang_{k}, 0) + coalesce(band_{k}, 0)) / 2" for k in CLASSES}
    best = f"greatest({', '.join(mean.values())})"
    pick = "case " + " ".join(f"when {mean[k]} = {best} then '{k}'" for k in CLASSES) + " end"
    sql = """
with docs as materialized (select doc_id, lang, case when n_chars < 300 then 'short' when n_chars < 3000 then 'middle' else 'long' end as band from documents),
labelled0 as materialized (
    select d.*, case when toxic = 1 then 'toxic' when quality = 0 then 'poor' else 'clean' end as label, 0 as round
    from docs d join labels using (doc_id)),
pool0 as materialized (select * from docs where doc_id not in (select doc_id from labels))
"""
    for n in range(1, rounds + 1):
        sql += f""",
lang{n} as (select lang, {share['lang']} from labelled{n - 1} group by 1),
band{n} as (select band, {share['band']} from labelled{n - 1} group by 1),
scored{n} as materialized (
    select p.doc_id, p.lang, p.band, {pick} as label, {best} as confidence
    from pool{n - 1} p left join lang{n} on lang{n}.lang = p.lang left join band{n} on band{n}.band = p.band),
labelled{n} as materialized (
    select * from labelled{n - 1} union all
    select doc_id, lang, band, label, {n} from scored{n} where confidence >= {threshold}),
pool{n} as materialized (select doc_id, lang, band from scored{n} where confidence < {threshold})
"""
    return sql


ROUNDS, SHARE_THRESHOLD = vocab.MAX_ROUNDS, 0.76  # a round that adds nothing is the last; in SQL the others then add nothing


def _by_frequency(t: Tables):
    band = F.when(F.col("n_chars") < 300, "short").when(F.col("n_chars") < 3000, "middle").otherwise("long")
    gold, pool = (df.withColumn("band", band).select("doc_id", "lang", "band", *extra) for df, extra in zip(gold_and_pool(t), (["label"], [])))
    scorer = frequency_scorer("label", CLASSES, [["lang"], ["band"]])
    return self_train(gold, pool, "doc_id", "label", ["lang", "band"], scorer, SHARE_THRESHOLD, ROUNDS)


@query(_self_training_sql(ROUNDS, SHARE_THRESHOLD) + f"select doc_id, label, case when round = 0 then 'gold' else 'pseudo' end as origin, round from labelled{ROUNDS}")
def self_training_labels(t: Tables) -> DataFrame:
    return _by_frequency(t).labelled.select("doc_id", "label", "origin", "round")


@query(_self_training_sql(ROUNDS, SHARE_THRESHOLD) + f"""
, taken as (select round, label, count(*) as n from labelled{ROUNDS} where round > 0 group by 1, 2)
select cast(round as int) as iteration, cast(sum(n) as bigint) as n_pseudo_added,
    cast((select count(*) from labelled0) + sum(sum(n)) over (order by round) as bigint) as n_total_labeled,
    cast((select count(*) from pool0) - sum(sum(n)) over (order by round) as bigint) as n_remaining_unlabeled,
    '{{' || string_agg('''' || label || ''': ' || n, ', ' order by n desc, label) || '}}' as pseudo_label_dist
from taken group by round
""")
def self_training_log(t: Tables) -> DataFrame:
    return _by_frequency(t).log


@query("""
select name as "column", present as n_present, total as n_total from (
    select count(*) as total, count(*) filter (source <> 'src0') as lines, count(nullif(length(text), 0)) as digits from documents)
cross join lateral (values ('n_chars', total), ('n_lines', lines), ('digit_share', digits)) as v(name, present)
""")
def feature_coverage(t: Tables) -> DataFrame:
    return coverage(document_features(t.documents), ["n_chars", "n_lines", "digit_share"])


@query("""
with docs as (select doc_id, n_chars::double as n_chars, nullif(lang, 'de') as lang, doc_id in (select doc_id from labels) as gold from documents),
fitted as (select avg(n_chars) as mu, stddev_pop(n_chars) as sd from docs where gold),
mode as (select lang as most from docs where gold and lang is not null group by 1 order by count(*) desc, 1 limit 1)
select doc_id, round((n_chars - mu) / sd, 6) as n_chars, filled = 'en' as en, filled = 'es' as es, filled = 'fr' as fr
from (select *, coalesce(lang, most) as filled from docs, mode), fitted
""")
def preprocessed_documents(t: Tables) -> DataFrame:
    """Fitted on labelled documents, applied to all; one language is unknown everywhere and takes the most frequent one."""
    documents = t.documents.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), F.nullif("lang", F.lit("de")).alias("lang"))
    fitted = fit_preprocessor(documents.join(t.labels, "doc_id", "left_semi"), ["n_chars"], "lang")
    values = vector_to_array("features")
    flags = [F.get(values, i + 1).cast("boolean").alias(name.removeprefix("cat__lang_")) for i, name in enumerate(fitted.feature_names[1:])]
    return fitted.transform(documents).select("doc_id", F.round(F.get(values, 0), 6).alias("n_chars"), *flags)


@query()
def model_comparison(t: Tables) -> DataFrame:
    """Three classifiers, out-of-fold."""
    gold, _ = gold_and_pool(t)
    return compare_models(gold, SETTING)


@query()
def self_training_with_forest(t: Tables) -> DataFrame:
    gold, pool = gold_and_pool(t)
    training = train_iteratively(gold, pool, SETTING)
    return training.log.withColumn("ended", F.lit(training.ended))


@query()
def phase_comparison(t: Tables) -> DataFrame:
    """Supervised baseline against self-training, both tested on gold rows only."""
    gold, pool = gold_and_pool(t)
    return compare_phases(gold, pool, SETTING).comparison


@query()
def phase_confusion_matrix(t: Tables) -> DataFrame:
    gold, pool = gold_and_pool(t)
    return compare_phases(gold, pool, SETTING).confusion


def _bundle(t: Tables):
    gold, pool = gold_and_pool(t)
    labelled = train_iteratively(gold, pool, SETTING).labelled
    return labelled, final_bundle(labelled, SETTING, [*NUMERIC, "lang"], "origin")


@query()
def forest_attributions(t: Tables) -> DataFrame:
    """Mean |attribution| per class and feature of the final forest."""
    labelled, bundle = _bundle(t)
    return attribution_table(labelled, bundle)


@query()
def forest_top_features(t: Tables) -> DataFrame:
    labelled, bundle = _bundle(t)
    return top_features(overall_importance(attribution_table(labelled, bundle)), 5)


@query()
def compare_phase_attributions(t: Tables) -> DataFrame:
    """Feature ranking of the forest on gold rows against the forest on gold and pseudo-labelled rows."""
    gold, _ = gold_and_pool(t)
    labelled, second = _bundle(t)
    first = final_bundle(gold, SETTING, [*NUMERIC, "lang"])
    return compare_attributions(attribution_table(gold, first), attribution_table(labelled, second))


@query()
def score_documents(t: Tables) -> DataFrame:
    """The final model saved, loaded and applied to every document."""
    _, bundle = _bundle(t)
    path = f"{shared_folder(t.spark)}/bundle-{uuid.uuid4().hex}"
    bundle.save(path)
    scored = score(document_features(t.documents), load_bundle(t.spark, path), prepare=lambda df: df, by_cell=True)
    return prediction_table(scored).select("doc_id", "Predicted Class", "Confidence", "Top Feature")


# What holds whatever the forests draw: computed from the models' real output over all rows, and by SQL from the tables.

GOLD_SQL = """
with gold as (select doc_id, case when toxic = 1 then 'toxic' when quality = 0 then 'poor' else 'clean' end as label from labels join documents using (doc_id)),
classes as (select label, count(*) as n, count(distinct doc_id) as ids from gold group by label)
"""


def _support(predictions: DataFrame, name: str) -> DataFrame:
    return predictions.groupBy(F.col("model").alias(name), "label").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids"))


@query(GOLD_SQL + "select model, label, n, ids from classes cross join (values ('LogisticRegression'), ('RandomForest'), ('BoostedTrees')) m(model)")
def model_support(t: Tables) -> DataFrame:
    """Every gold row is predicted once by each classifier."""
    gold, _ = gold_and_pool(t)
    predictions = model_predictions(gold, SETTING)
    return _support(predictions.select("model", "doc_id", F.col("actual").alias("label")), "model")


@query(GOLD_SQL + "select tag, label, n, ids from classes cross join (values ('Phase1_Supervised_Baseline'), ('Phase2_SemiSupervised_Honest')) p(tag)")
def phase_support(t: Tables) -> DataFrame:
    """Both phases are tested on every gold row and on no other."""
    gold, pool = gold_and_pool(t)
    predictions = compare_phases(gold, pool, SETTING).predictions
    return _support(predictions.select("model", "doc_id", F.col("actual").alias("label")), "tag")


@query("""
with gold as (select doc_id from labels join documents using (doc_id)), pool as (select doc_id from documents where doc_id not in (select doc_id from labels))
select (select count(*) from gold) as n_gold, (select count(*) from gold) + (select count(*) from pool) as n_all, true as every_round_adds_up, true as confident, true as from_pool
""")
def self_training_conserves_rows(t: Tables) -> DataFrame:
    """No round loses or doubles a row, takes one below the threshold or one that is not of the pool."""
    gold, pool = gold_and_pool(t)
    training = train_iteratively(gold, pool, SETTING)
    ids = training.labelled.groupBy().agg(F.count("*").alias("n_labelled"), F.count_if(F.col("origin") == "gold").alias("n_gold"), F.count_distinct("doc_id").alias("ids"))
    left = training.remaining.agg(F.count("*").alias("n_left"))
    log = training.log.agg(F.sum("n_pseudo_added").alias("added"), F.min(F.col("n_total_labeled") + F.col("n_remaining_unlabeled")).alias("least"), F.max(F.col("n_total_labeled") + F.col("n_remaining_unlabeled")).alias("most"))
    strange = training.pseudo.join(pool.select("doc_id"), "doc_id", "left_anti").agg(F.count("*").alias("strange"))
    one = ids.join(F.broadcast(left)).join(F.broadcast(log)).join(F.broadcast(strange))  # one row each
    everything = F.col("n_labelled") + F.col("n_left")
    return one.select(
        "n_gold", everything.alias("n_all"), (F.coalesce(F.col("least") == everything, F.lit(True)) & F.coalesce(F.col("most") == everything, F.lit(True))).alias("every_round_adds_up"),
        (F.col("n_labelled") - F.col("n_gold") == F.coalesce("added", F.lit(0))).alias("confident"), ((F.col("strange") == 0) & (F.col("ids") == F.col("n_labelled"))).alias("from_pool"),
    )


@query("select doc_id, 3 as n_classes, true as adds_up from documents")
def attributions_add_up(t: Tables) -> DataFrame:
    """Base value and attributions make the forest's probability, for every document and class."""
    bundle = final_bundle(gold_and_pool(t)[0], SETTING, [*NUMERIC, "lang"])
    bases = [r["base"] for r in base_values(bundle.paths).orderBy("class_index").collect()]  # one row per class
    width = len(bundle.feature_names)
    explained = explain(document_features(t.documents), bundle).withColumn("p", vector_to_array("probability"))
    sums = [F.aggregate(F.slice("phi", i * width + 1, width), F.lit(base), lambda a, b: a + b) for i, base in enumerate(bases)]
    off = F.greatest(*[F.abs(total - F.get("p", i)) for i, total in enumerate(sums)])
    return explained.select("doc_id", F.size("p").alias("n_classes"), (off < 1e-9).alias("adds_up"))


@query(GOLD_SQL + """, sizes as (select (select count(*) from classes) as k, 4 + (select count(distinct lang) from documents join gold using (doc_id)) as f)
select 'model_comparison' as name, 3 as n, true as whole from sizes union all select 'phase_comparison', 2, true from sizes union all
select 'attributions', k * f, true from sizes union all select 'phase_attributions', 2 * k * f, true from sizes
""")
def experiment_outputs(t: Tables) -> DataFrame:
    """The written results, read back."""
    gold, pool = gold_and_pool(t)
    out = f"{shared_folder(t.spark)}/experiment-{uuid.uuid4().hex}"
    write_experiment(out, gold, pool, SETTING)
    keys = {"model_comparison": ["model"], "phase_comparison": ["tag"], "attributions": ["class", "feature"], "phase_attributions": ["phase", "class", "feature"]}
    counts = [
        t.spark.read.csv(f"{out}/{name}", header=True).agg(F.lit(name).alias("name"), F.count("*").alias("n"), (F.count_distinct(*key) == F.count("*")).alias("whole"))
        for name, key in keys.items()
    ]
    return counts[0].unionAll(counts[1]).unionAll(counts[2]).unionAll(counts[3])


@query("select cast(doc_id as varchar) as doc_id, source, true as known_class, true as sure from documents")
def score_upload(t: Tables) -> DataFrame:
    """A table as it is uploaded, with columns the model does not know, scored and written with the published columns."""
    bundle = final_bundle(gold_and_pool(t)[0], SETTING, [*NUMERIC, "lang"])
    folder = f"{shared_folder(t.spark)}/upload-{uuid.uuid4().hex}"
    write_table(document_features(t.documents), f"{folder}/in", "csv")
    scored = prediction_table(score(scoring_input(t.spark, f"{folder}/in"), bundle, prepare=lambda df: df))
    write_table(scored, f"{folder}/out", "csv")
    back = t.spark.read.csv(f"{folder}/out", header=True)
    return back.select("doc_id", "source", F.col("Predicted Class").isin(CLASSES).alias("known_class"), F.col("Confidence").cast("double").between(1 / 3 - 1e-9, 1.0).alias("sure"))


@query(GOLD_SQL + """, features as (
    select unnest(['num__n_chars', 'num__n_words', 'num__n_lines', 'num__digit_share', 'intercept']) as feature
    union all select distinct 'cat__lang_' || lang from documents join gold using (doc_id))
select label as class, feature, true as optimal from classes cross join features
""")
def logistic_optimality(t: Tables) -> DataFrame:
    """The penalised loss has no slope in any coefficient of the fitted regression, over all its rows."""
    gold, _ = gold_and_pool(t)
    figures = figures_of(gold, list(NUMERIC), "lang", "label")
    prepared, classes = preprocessor_of(figures, gold, "lang"), sorted(figures.labels)
    rows = prepared.transform(gold).select("features", class_weight(figures.labels, "label").alias("_weight"), class_index("label", classes).alias("_class"))
    rows = written(rows, "training")
    gradient = logistic_gradient(logistic_regression(figures.rows).fit(rows), rows, classes, prepared.feature_names)
    return gradient.select("class", "feature", (F.abs("gradient") < 1e-5).alias("optimal"))


# The folds, the preparation inside them, the balanced weights and the phases, proven by values: the same loops with a
# classifier whose predictions SQL can express.

CELL_NUMERIC = ("n_chars", "n_lines", "digit_share")
BY_CELL = Setting(row_id="doc_id", label="label", numeric=CELL_NUMERIC, categorical="lang", threshold=SHARE_THRESHOLD)


def _cell(features: Column) -> Column:
    """Whole deviations from the mean of each number, -1 to 1, and the language's flags."""
    deviations = F.transform(F.slice(features, 1, len(CELL_NUMERIC)), lambda x: F.greatest(F.lit(-1), F.least(F.lit(1), F.floor(x))))
    flags = F.transform(F.slice(features, len(CELL_NUMERIC) + 1, F.size(features)), lambda x: x.cast("bigint"))
    return F.concat_ws(",", F.concat(deviations, flags).cast("array<string>"))


def _class_shares() -> ClassShares:
    return ClassShares(_cell, len(CLASSES))


CELL_FEATURES_SQL = """
features as materialized (
    select doc_id, lang, n_chars::double as n_chars, case when source <> 'src0' then (length(text) - length(replace(text, chr(10), '')) + 1)::double end as n_lines,
        (length(text) - length(translate(text, '0123456789', ''))) / nullif(length(text), 0) as digit_share
    from documents),
folded as materialized (
    select f.*, label, (row_number() over (partition by label order by md5('42-' || doc_id), doc_id) - 1) % 5 as fold
    from features f join (select doc_id, case when toxic = 1 then 'toxic' when quality = 0 then 'poor' else 'clean' end as label from labels) using (doc_id))
"""


def _cell_predictions_sql(name: str, model: str, extra: str = "") -> str:
    """Tables ending in ``name``; the last, ``predicted_<name>``, has model, fold, actual and predicted."""
    filled = {c: f"coalesce({c}, m_{c})" for c in CELL_NUMERIC}
    deviations = " || ',' || ".join(f"greatest(-1, least(1, floor(({filled[c]} - a_{c}) / s_{c})))::int" for c in CELL_NUMERIC)
    return f"""
train_{name} as materialized (select f, g.* exclude (fold) from (select unnest(range(5)) as f) join folded g on g.fold <> f {extra}),
medians_{name} as (select f, {', '.join(f'median({c}) as m_{c}' for c in CELL_NUMERIC)} from train_{name} group by f),
scales_{name} as materialized (
    select f, {', '.join(f'any_value(m_{c}) as m_{c}, avg({filled[c]}) as a_{c}, stddev_pop({filled[c]}) as s_{c}' for c in CELL_NUMERIC)}
    from train_{name} join medians_{name} using (f) group by f),
weights_{name} as (select f, label, sum(n) over (partition by f) / (count(*) over (partition by f) * n) as weight from (select f, label, count(*) as n from train_{name} group by all)),
cells_{name} as (select f, lang || ',' || {deviations} as cell, label, count(*) as n from train_{name} join scales_{name} using (f) group by all),
winners_{name} as (select f, cell, label from cells_{name} join weights_{name} using (f, label) qualify row_number() over (partition by f, cell order by n * weight desc, label) = 1),
predicted_{name} as materialized (
    select '{model}' as model, t.fold, t.actual, coalesce(w.label, 'clean') as predicted
    from (select fold, label as actual, lang || ',' || {deviations} as cell from folded g join scales_{name} s on s.f = g.fold) t
    left join winners_{name} w on w.f = t.fold and w.cell = t.cell)
"""


CELL_SQL = f"with {CELL_FEATURES_SQL}, {_cell_predictions_sql('one', 'ClassShares')}, predicted as (select * from predicted_one)"


def _by_cells(t: Tables) -> DataFrame:
    gold, _ = gold_and_pool(t)
    return model_predictions(gold, BY_CELL, lambda n: {"ClassShares": _class_shares()})


@query(CELL_SQL + REPORT_SQL + """
select model, fold::int as fold, round(accuracy, 10) as accuracy, round(macro_f1, 10) as macro_f1
from (select model, fold, avg((actual = predicted)::int) as accuracy from predicted group by all)
join (select model, fold, avg(2 * hit / (guessed + support)) as macro_f1 from per_class group by all) using (model, fold)
""")
def class_shares_by_fold(t: Tables) -> DataFrame:
    """Accuracy and F1 of every fold."""
    counts = metrics.confusion_counts(_by_cells(t), ["model", "fold"])
    both = metrics.accuracy(counts, ["model", "fold"]).join(metrics.macro_f1(counts, ["model", "fold"]), ["model", "fold"])
    return both.select("model", "fold", F.round("accuracy", 10).alias("accuracy"), F.round("macro_f1", 10).alias("macro_f1"))


@query(CELL_SQL + REPORT_SQL + """
select class, round(precision, 10) as precision, round(recall, 10) as recall, round(f1, 10) as f1, cast(support as bigint) as support from pooled
union all select 'macro avg', round(avg(precision), 10), round(avg(recall), 10), round(avg(f1), 10), cast(sum(support) as bigint) from pooled
union all select 'weighted avg', round(sum(precision * support) / sum(support), 10), round(sum(recall * support) / sum(support), 10),
    round(sum(f1 * support) / sum(support), 10), cast(sum(support) as bigint) from pooled
""")
def class_shares_report(t: Tables) -> DataFrame:
    """All folds together."""
    report = metrics.class_report(metrics.confusion_counts(_by_cells(t), []), [])
    both = report.unionByName(metrics.averaged_report(report, []))
    return both.withColumns({m: F.round(m, 10) for m in ("precision", "recall", "f1")})


PHASE_SQL = (
    _self_training_sql(ROUNDS, SHARE_THRESHOLD) + f", {CELL_FEATURES_SQL}, pseudo as materialized (select f.*, label from features f join labelled{ROUNDS} l using (doc_id) where round > 0), "
    + _cell_predictions_sql("one", "Phase1_Supervised_Baseline") + ", "
    + _cell_predictions_sql("two", "Phase2_SemiSupervised_Honest", "union all select f, p.* from (select unnest(range(5)) as f) cross join pseudo p")
    + ", predicted as (select * from predicted_one union all select * from predicted_two)"
)


def _phases_by_cells(t: Tables) -> Phases:
    gold, pool = gold_and_pool(t)
    band = F.when(F.col("n_chars") < 300, "short").when(F.col("n_chars") < 3000, "middle").otherwise("long")

    def scorer(labelled: DataFrame):
        score = frequency_scorer("label", CLASSES, [["lang"], ["band"]])(labelled.withColumn("band", band))
        return lambda rows: score(rows.withColumn("band", band))

    return compare_phases(gold, pool, BY_CELL, scorer=scorer, estimator=_class_shares)


@query(PHASE_SQL + REPORT_SQL + f"""
, fold_scores as (
    select model, fold, accuracy, macro_f1 from
        (select model, fold, avg((actual = predicted)::int) as accuracy from predicted group by all)
        join (select model, fold, avg(2 * hit / (guessed + support)) as macro_f1 from per_class group by all) using (model, fold))
select model as tag, round(accuracy, 10) as accuracy, round(accuracy_mean, 10) as accuracy_mean, round(accuracy_std, 10) as accuracy_std,
    round(macro_f1, 10) as macro_f1, round(macro_f1_mean, 10) as macro_f1_mean, round(macro_f1_std, 10) as macro_f1_std,
    {', '.join(f'round(f1_{c}, 10) as f1_{c}' for c in CLASSES)},
    (select count(*) from folded) as n_gold_labeled, case when model like 'Phase2%' then (select count(*) from pseudo) else 0 end as n_pseudo_labeled
from (select model, avg((actual = predicted)::int) as accuracy from predicted group by 1)
join (select model, avg(accuracy) as accuracy_mean, stddev_pop(accuracy) as accuracy_std, avg(macro_f1) as macro_f1_mean, stddev_pop(macro_f1) as macro_f1_std from fold_scores group by 1) using (model)
join (select model, avg(f1) as macro_f1, {', '.join(f"max(f1) filter (class = '{c}') as f1_{c}" for c in CLASSES)} from pooled group by 1) using (model)
""")
def class_shares_phases(t: Tables) -> DataFrame:
    """The gold-only comparison of both phases: pseudo-labels by frequency, predictions by cell."""
    table = _phases_by_cells(t).comparison
    return table.select("tag", *[F.round(c, 10).alias(c) if c.startswith(("accuracy", "macro", "f1")) else c for c in table.columns if c != "tag"])


@query(PHASE_SQL + " select actual, " + ", ".join(f"count(*) filter (predicted = '{c}') as {c}" for c in CLASSES) + " from predicted_two group by 1")
def class_shares_confusion(t: Tables) -> DataFrame:
    return _phases_by_cells(t).confusion
