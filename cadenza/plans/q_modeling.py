"""Modeling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import modeling as M
from cadenza.operators.indexing import with_row_index
from cadenza.plans.catalog import register
from cadenza.plans.oracle import r, with_ctes
from cadenza.plans.q_association import build_feature_table

LABEL = "num_followers"
FEATURES = ["p_size", "p_retailprice", "num_tracks", "num_artists", "num_albums", "genre_count"]
U_SQL = M.key_uniform_sql("pid", M.SPLIT_SALT)
DRAW_SQL = M.key_uniform_sql("pid", M.SAMPLE_SALT)

# The undersampled classes are chosen from the data: the most frequent label
# value and the next most frequent (ties by smaller value); the reference
# hard-codes 1 and 2 follower(s), its two largest classes.
_CUT = f"SELECT pid, {LABEL} FROM ftable WHERE {LABEL} < (SELECT quantile_disc({LABEL}, 0.999) FROM ftable)"
_CLASSES = {
    "cut": _CUT,
    "sizes": f"SELECT {LABEL} AS v, count(*) AS n FROM cut GROUP BY 1",
    "maj": "SELECT v FROM sizes ORDER BY n DESC, v LIMIT 1",
    "mino": "SELECT v FROM sizes WHERE v <> (SELECT v FROM maj) ORDER BY n DESC, v LIMIT 1",
    "frac": f"""SELECT least(1.0, CAST((SELECT count(*) FROM cut WHERE {LABEL} = (SELECT v FROM mino)) AS DOUBLE)
                / NULLIF((SELECT count(*) FROM cut WHERE {LABEL} = (SELECT v FROM maj)), 0)) AS f""",
    "us": f"""SELECT * FROM cut WHERE {LABEL} IS DISTINCT FROM (SELECT v FROM maj)
              OR {DRAW_SQL} < (SELECT f FROM frac)""",
}


def _feature_table(spark, d):
    return build_feature_table(spark, d)


def _classes(df):
    sizes = M.class_sizes(df, LABEL)
    order = F.struct(F.col("n"), (-F.col(LABEL)).alias("neg"))
    majority = sizes.select(F.max_by(LABEL, order)).scalar()
    minority = sizes.where(F.col(LABEL) != majority).select(F.max_by(LABEL, order)).scalar()
    return majority, minority


def _all_techniques(spark, d):
    """Outliers removed, majority class undersampled, log label (the reference's final run)."""
    ft = _feature_table(spark, d)
    cut = M.remove_outliers(ft, LABEL)
    majority, minority = _classes(cut)
    return M.log_target(M.undersample(cut, LABEL, majority, minority), LABEL)


def _prepared_for_fitting(spark, d):
    """The prepared rows written once before model fitting reads them many times."""
    from cadenza.session import materialize

    return materialize(_all_techniques(spark, d).where(F.col(LABEL).isNotNull()))


@register("outlier_cut", with_ctes(["ftable"], f"SELECT pid, {r(LABEL)} AS {LABEL} FROM ({_CUT}) t"), "M1 A9 F4")
def outlier_cut(spark, d):
    return M.remove_outliers(_feature_table(spark, d), LABEL).select("pid", LABEL)


@register(
    "undersample_hash",
    with_ctes(["ftable"], f"SELECT pid, {r(LABEL)} AS {LABEL} FROM us", _CLASSES),
    "M2 F5 T10",
)
def undersample_hash(spark, d):
    cut = M.remove_outliers(_feature_table(spark, d), LABEL)
    majority, minority = _classes(cut)
    return M.undersample(cut, LABEL, majority, minority).select("pid", LABEL)


@register(
    "split_class_shares",
    with_ctes(["ftable"], f"""SELECT CASE WHEN {LABEL} = (SELECT v FROM maj) THEN 'majority'
              WHEN {LABEL} = (SELECT v FROM mino) THEN 'minority' ELSE 'other' END AS class,
            count(*) FILTER (WHERE {U_SQL} < 0.8) AS n_train, count(*) FILTER (WHERE {U_SQL} >= 0.8) AS n_test
        FROM us GROUP BY 1""", _CLASSES),
    "M2 M4 T11",
)
def split_class_shares(spark, d):
    """Rows of each class in both sets after undersampling (near 80 and 20 percent in every class)."""
    cut = M.remove_outliers(_feature_table(spark, d), LABEL)
    majority, minority = _classes(cut)
    train, test = M.hash_split(M.undersample(cut, LABEL, majority, minority))
    both = train.withColumn("s", F.lit("train")).unionByName(test.withColumn("s", F.lit("test")))
    name = F.when(F.col(LABEL) == majority, "majority").when(F.col(LABEL) == minority, "minority").otherwise("other")
    return both.groupBy(name.alias("class")).agg(
        F.count_if(F.col("s") == "train").alias("n_train"), F.count_if(F.col("s") == "test").alias("n_test")
    )


@register(
    "log_target",
    with_ctes(["ftable"], f"SELECT pid, {r(f'CASE WHEN {LABEL} > 0 THEN ln({LABEL}) END')} AS {LABEL} FROM ftable"),
    "M3 X9 T9",
)
def log_target(spark, d):
    return M.log_target(_feature_table(spark, d), LABEL).select("pid", LABEL)


@register(
    "hash_split",
    with_ctes(["ftable"], f"SELECT pid, CASE WHEN {U_SQL} < 0.8 THEN 'train' ELSE 'test' END AS split FROM ftable"),
    "M4 U2 T11",
)
def hash_split(spark, d):
    train, test = M.hash_split(_feature_table(spark, d))
    return train.select("pid", F.lit("train").alias("split")).unionByName(test.select("pid", F.lit("test").alias("split")))


def _metrics_sql(source_cte: str, label_expr: str) -> str:
    return f"""SELECT s AS "set", count(*) AS n, {r('sqrt(avg((y - mu) * (y - mu)))')} AS rmse,
            {r('1 - sum((y - mu) * (y - mu)) / (var_pop(y) * count(*))')} AS r2
        FROM (SELECT pid, {label_expr} AS y, CASE WHEN {U_SQL} < 0.8 THEN 'train' ELSE 'test' END AS s
              FROM {source_cte}) t,
             (SELECT avg(y) AS mu FROM (SELECT {label_expr} AS y, {U_SQL} AS u FROM {source_cte}) z WHERE u < 0.8) m
        WHERE y IS NOT NULL
        GROUP BY s"""


def _baseline_metrics(prepared):
    train, test = M.hash_split(prepared)
    train, test = M.with_baseline(train, test, LABEL)
    return M.metrics_table({"train": train, "test": test}, LABEL, "baseline_prediction")


@register(
    "baseline_metrics",
    with_ctes(["ftable"], _metrics_sql("us", f"CASE WHEN {LABEL} > 0 THEN ln({LABEL}) END"), _CLASSES),
    "M5 M6 A10 M1 M2 M3 M4",
)
def baseline_metrics(spark, d):
    from cadenza.session import materialize

    # Materialised before the split: both sets and the training mean read the
    # same prepared rows (T11), without re-running the preparation subqueries.
    return _baseline_metrics(materialize(_all_techniques(spark, d)))


@register("regression_metrics", with_ctes(["ftable"], _metrics_sql("ftable", LABEL)), "M6 M5")
def regression_metrics(spark, d):
    return _baseline_metrics(_feature_table(spark, d))


@register(
    "unpivot_metrics",
    with_ctes(["ftable"], f"""SELECT "set", 'rmse' AS metric, rmse AS value FROM ({_metrics_sql("ftable", LABEL)}) a
        UNION ALL SELECT "set", 'r2', r2 FROM ({_metrics_sql("ftable", LABEL)}) b"""),
    "P13",
)
def unpivot_metrics(spark, d):
    wide = _baseline_metrics(_feature_table(spark, d))
    return M.metrics_long(wide, ["set"], ["rmse", "r2"])


@register(
    "rank_predictions",
    with_ctes(["ftable"], f"""SELECT pid, {r(LABEL)} AS {LABEL}, {r('mu')} AS baseline_prediction,
            row_number() OVER (ORDER BY {LABEL}, pid) - 1 AS rank
        FROM ftable, (SELECT avg({LABEL}) AS mu FROM ftable WHERE {U_SQL} < 0.8) m
        WHERE {U_SQL} >= 0.8"""),
    "W2 S6",
)
def rank_predictions(spark, d):
    train, test = M.hash_split(_feature_table(spark, d))
    _, test = M.with_baseline(train, test, LABEL)
    scored = test.select("pid", LABEL, "baseline_prediction")
    return with_row_index(scored, [F.col(LABEL), F.col("pid")], "rank")


# ---------------------------------------------------------------- forest (rows-only checks)


@register("forest_cv_metrics", None, "M7 M8 M9 M10 M11 M12")
def forest_cv_metrics(spark, d):
    """The whole grid of 90 points by 3 folds; see ``operators.search`` for the work that points share."""
    from cadenza.operators.search import search_report, search_results

    train, _ = M.hash_split(_prepared_for_fitting(spark, d))
    return search_report(search_results(train, FEATURES, LABEL))


@register("forest_importances", None, "M12 M9")
def forest_importances(spark, d):
    train, _ = M.hash_split(_prepared_for_fitting(spark, d))
    pipeline, _ = M.forest_pipeline(FEATURES, LABEL)
    return M.importances(spark, pipeline.fit(train), FEATURES)


@register("forest_predictions", None, "M13 K2 K7 T12")
def forest_predictions(spark, d):
    import uuid

    from pyspark.ml import PipelineModel

    from cadenza.session import ensure_checkpoint_dir
    from cadenza.sources.sinks import save_model

    train, test = M.hash_split(_prepared_for_fitting(spark, d))
    train, test = M.with_baseline(train, test, LABEL)
    pipeline, _ = M.forest_pipeline(FEATURES, LABEL)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cadenza-model-{uuid.uuid4().hex}"
    save_model(pipeline.fit(train), path)
    return M.score(PipelineModel.load(path), test, "pid", LABEL)


_TEST_ROWS = f"""SELECT pid, {r('y')} AS {LABEL}, {r('mu')} AS baseline_prediction
        FROM (SELECT pid, CASE WHEN {LABEL} > 0 THEN ln({LABEL}) END AS y FROM us) t,
             (SELECT avg(CASE WHEN {LABEL} > 0 THEN ln({LABEL}) END) AS mu FROM us WHERE {U_SQL} < 0.8) m
        WHERE y IS NOT NULL AND {U_SQL} >= 0.8"""


@register(
    "forest_prediction_rows",
    with_ctes(["ftable"], f"SELECT pid, {LABEL}, baseline_prediction, true AS predicted FROM ({_TEST_ROWS}) x", _CLASSES),
    "M13 M5 T12",
)
def forest_prediction_rows(spark, d):
    """Every test row is scored, also with NULL features, by the model saved and loaded again."""
    scored = forest_predictions(spark, d)
    return scored.select("pid", LABEL, "baseline_prediction", F.col("prediction").isNotNull().alias("predicted"))


_MEANS = ", ".join(f"avg({c}) AS m_{c}" for c in FEATURES)
_SPREADS = ", ".join(f"stddev_samp(coalesce({c}, m_{c})) AS s_{c}" for c in FEATURES)
_SCALED = ", ".join(f"{r(f'coalesce({c}, m_{c}) / s_{c}')} AS {c}" for c in FEATURES)


@register(
    "scaled_features",
    with_ctes(["ftable"], f"SELECT pid, {_SCALED} FROM ftable, means, spreads", {
        "means": f"SELECT {_MEANS} FROM ftable WHERE {U_SQL} < 0.8",
        "spreads": f"SELECT {_SPREADS} FROM ftable, means WHERE {U_SQL} < 0.8",
    }),
    "M7 M8 M9",
)
def scaled_features(spark, d):
    """Imputation and scaling, fitted on the training set, over all rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    table = _feature_table(spark, d)
    train, _ = M.hash_split(table)
    pipeline, _ = M.forest_pipeline(FEATURES, LABEL)
    out = Pipeline(stages=pipeline.getStages()[:-1]).fit(train).transform(table)
    values = vector_to_array("scaled_features")
    return out.select("pid", *[values[i].alias(c) for i, c in enumerate(FEATURES)])


# ---------------------------------------------------------------- a forest that SQL can grow as well

# One tree on all rows and features, whose split places are all midpoints of
# neighbouring values (fewer distinct values than bins): SQL grows the same tree.
TREE_FEATURES = ["num_tracks", "num_albums", "genre_count"]
TREE = M.ForestSpec(num_trees=1, subset_strategy="all", max_depth=3, max_bins=4096, bootstrap=False)


def _tree_sql() -> dict[str, str]:
    """CTEs: ``t_rows`` (train and test rows), ``split_k`` and ``at_k`` (node of each row) per level, ``inner_nodes``."""
    filled = ", ".join(f"coalesce({f}, m_{f}) AS {f}" for f in TREE_FEATURES)
    means = ", ".join(f"avg({f}) AS m_{f}" for f in TREE_FEATURES)
    long = " UNION ALL ".join(f"SELECT pid, node, y, {i} AS f, CAST({f} AS DOUBLE) AS v FROM at_{{k}} WHERE train" for i, f in enumerate(TREE_FEATURES))
    out = {
        "t_all": f"""SELECT ftable.*, CASE WHEN {LABEL} > 0 THEN ln({LABEL}) END AS y, {U_SQL} < 0.8 AS train
                     FROM ftable SEMI JOIN us USING (pid)""",
        "t_means": f"SELECT {means} FROM t_all WHERE train AND y IS NOT NULL",
        "at_0": f"SELECT pid, y, train, 0 AS node, {filled} FROM t_all, t_means WHERE y IS NOT NULL",
        "steps": "SELECT f, v, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2 AS threshold FROM (SELECT DISTINCT f, v FROM ("
        + long.format(k=0)
        + ") d) e",
    }
    for k in range(TREE.max_depth):
        out[f"long_{k}"] = long.format(k=k)
        out[f"sums_{k}"] = f"""SELECT *, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(q) OVER w AS lq, sum(n) OVER a AS tn, sum(s) OVER a AS ts, sum(q) OVER a AS tq
            FROM (SELECT node, f, v, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s, sum(y * y) AS q FROM long_{k} GROUP BY node, f, v) g
            WINDOW w AS (PARTITION BY node, f ORDER BY v), a AS (PARTITION BY node, f)"""
        out[f"gains_{k}"] = f"""SELECT node, f, v, tn AS n, (tq - ts * ts / tn) / tn - ln / tn * ((lq - ls * ls / ln) / ln)
                - (tn - ln) / tn * ((tq - lq - (ts - ls) * (ts - ls) / (tn - ln)) / (tn - ln)) AS gain
            FROM sums_{k} WHERE ln < tn"""
        out[f"split_{k}"] = f"""SELECT node, f, threshold, n, gain
            FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) AS place FROM gains_{k} WHERE gain > 0) b
            JOIN steps USING (f, v) WHERE place = 1"""
        value = "CASE f " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(TREE_FEATURES)) + " END"
        out[f"at_{k + 1}"] = f"""SELECT pid, y, train, CASE WHEN f IS NULL THEN node WHEN {value} <= threshold THEN 2 * node + 1 ELSE 2 * node + 2 END AS node,
                {", ".join(TREE_FEATURES)}
            FROM at_{k} LEFT JOIN split_{k} USING (node)"""
    out["inner_nodes"] = " UNION ALL ".join(f"SELECT * FROM split_{k}" for k in range(TREE.max_depth))
    return out


def _saved_tree(spark, d):
    """(nodes, model, test rows) of the single tree, saved and loaded again."""
    import uuid

    from pyspark.ml import PipelineModel

    from cadenza.operators.forest_table import saved_nodes
    from cadenza.session import ensure_checkpoint_dir
    from cadenza.sources.sinks import save_model

    train, test = M.hash_split(_prepared_for_fitting(spark, d))
    pipeline, _ = M.forest_pipeline(TREE_FEATURES, LABEL, TREE)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cadenza-model-{uuid.uuid4().hex}"
    save_model(pipeline.fit(train), path)
    return saved_nodes(spark, path), PipelineModel.load(path), test


_DEEP = TREE.max_depth


@register(
    "tree_predictions",
    with_ctes(["ftable"], f"""SELECT pid, {r('value')} AS prediction, {r('value')} AS node_prediction
        FROM at_{_DEEP} JOIN (SELECT node, avg(y) AS value FROM at_{_DEEP} WHERE train GROUP BY node) l USING (node) WHERE NOT train""", _CLASSES | _tree_sql()),
    "K7 M9 M10 M13 T12",
)
def tree_predictions(spark, d):
    """Every test row's prediction by the loaded model and by its node table; SQL grows the tree anew."""
    from cadenza.operators.forest_table import predict

    nodes, model, test = _saved_tree(spark, d)
    scored = model.transform(test)
    by_nodes = predict(nodes, scored, "scaled_features", ["pid"], TREE.max_depth).withColumnRenamed("prediction", "node_prediction")
    return scored.select("pid", "prediction").join(by_nodes, "pid")


@register(
    "tree_importances",
    with_ctes(["ftable"], f"""SELECT feature, {r('coalesce(g, 0) / (SELECT sum(gain * n) FROM inner_nodes)')} AS importance,
            {r('coalesce(g, 0) / (SELECT sum(gain * n) FROM inner_nodes)')} AS node_importance
        FROM (VALUES {", ".join(f"({i}, '{f}')" for i, f in enumerate(TREE_FEATURES))}) names(f, feature)
        LEFT JOIN (SELECT f, sum(gain * n) AS g FROM inner_nodes GROUP BY f) s USING (f)""", _CLASSES | _tree_sql()),
    "M12 M9 K7",
)
def tree_importances(spark, d):
    """Importances reported by the loaded model and summed from its node table; SQL grows the tree anew."""
    from cadenza.operators.forest_table import node_importances

    nodes, model, _ = _saved_tree(spark, d)
    own = node_importances(nodes, TREE_FEATURES).withColumnRenamed("importance", "node_importance")
    return M.importances(spark, model, TREE_FEATURES).join(own, "feature")


@register(
    "importances_identity",
    with_ctes(["ftable"], f"""SELECT {len(TREE_FEATURES)} AS features, 1.0 AS total, {r('sum(gain * n)')} AS weighted_gain
        FROM inner_nodes""", _CLASSES | _tree_sql()),
    "M12",
)
def importances_identity(spark, d):
    """The tree's importances sum to 1, and so do its nodes' gains to the weighted gain of the tree that SQL grows."""
    nodes, model, _ = _saved_tree(spark, d)
    total = M.importances(spark, model, TREE_FEATURES).agg(F.count("*").cast("int").alias("features"), F.round(F.sum("importance"), 6).alias("total"))
    return total.withColumn("weighted_gain", nodes.select(F.sum(F.col("gain") * F.col("n"))).scalar())


@register("ablation", None, "M14")
def ablation(spark, d):
    """Ten runs: every set of preparation flags with the default forest (20 trees, 3 folds), two sets tuned over the whole grid as well."""
    from cadenza.operators.search import run_matrix
    from cadenza.session import materialize

    ft = materialize(_feature_table(spark, d))
    majority, minority = _classes(M.remove_outliers(ft, LABEL))
    return run_matrix(ft, FEATURES, LABEL, majority=majority, minority=minority)
