"""Training, scoring and explanation queries.

Training is checked by targets that follow a rule: the predictions of a right model equal the rule's
labels in SQL, row by row.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog import register
from riskloom.catalog.evaluation import CARD_HASH, CARD_KEYS, split_ctes
from riskloom.catalog.features import CENTS
from riskloom.catalog.preparation import rounded
from riskloom.catalog.resampling import CARD_KEY, FEATURES, card_with_key, sql_word
from riskloom.fixtures import view, with_views
from riskloom.operators import derive, explain, models, sampling, trees
from riskloom.plans import engineer, interpret, prepare, score, train
from riskloom.session import scratch_path, written_once
from riskloom.sources import runs

# The four line keys repeat now and then; with the amount in cents they identify a row.
ROW_KEY = f"concat_ws('-', {', '.join(CARD_KEYS)}, CAST(round(Amount * 100) AS BIGINT))"


def keyed_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "card").withColumn("row_key", F.expr(ROW_KEY))


CARD_NUMBERS = ["V1", "V2", "V3", "V4", "V5", "Time", "Amount"]

# Every training query runs with the documented settings of its kind (``models.DEFAULTS``).
# The targets follow rules that a right model must reproduce row by row. Their columns hold a few
# whole numbers, so binning loses nothing; neither column alone decides the first one, and a line
# separates the second with room to spare.
RULES = {"risky": "V4 >= 0 AND V2 >= 4.5E0", "steep": "V4 > 0"}


def _labelled(spark: SparkSession, sf_dir: str, target: str = "risky") -> DataFrame:
    """Card rows split for training, with the target of a rule."""
    card = card_with_key(spark, sf_dir).withColumn(target, F.expr(RULES[target]).cast("int"))
    # Many passes follow: written once, in partitions of even size.
    return written_once(sampling.stratified_split(card, target, CARD_KEYS).hint("rebalance"), "labelled")


def _train(kind: str, task: str, target: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _labelled(spark, sf_dir, target)
        trainer = models.ModelTrainer(kind, task)
        trainer.train(rows.where("not is_test"), FEATURES, target)
        tested = trainer.predict(rows.where("is_test"))
        return tested.select("row_key", (F.col(models.SCORE) >= 0.5).cast("int").alias("predicted"))

    return run


def _rule_sql(target: str) -> str:
    ruled = f"ruled AS (SELECT *, CAST({RULES[target]} AS INTEGER) AS {target} FROM card)"
    return with_views(
        ["card"],
        f"WITH {ruled}, {split_ctes('ruled', target, CARD_HASH)} "
        f"SELECT {CARD_KEY} AS row_key, {target} AS predicted FROM split WHERE is_test",
    )


for _kind in models.DEFAULTS:
    _target = "steep" if _kind == "logistic" else "risky"
    register(f"train_{_kind}", _rule_sql(_target))(_train(_kind, "classifier", _target))
    if _kind != "logistic":
        register(f"train_{_kind}_regressor", _rule_sql(_target))(_train(_kind, "regressor", _target))


def _served(
    raw: DataFrame, out_dir: str, dataset: str, kinds: tuple[str, ...], key: str, ranges: DataFrame | None = None
) -> DataFrame:
    """Raw rows scored by every saved kind: (model, key, label)."""
    out = None
    for kind in kinds:
        preparation, model = score.load_version(out_dir, dataset, kind)
        scored = score.score_rows(raw, dataset, preparation, model, ranges, row_key=key)
        scored = scored.select(F.lit(kind).alias("model"), key, F.col(score.LABEL).alias("label"))
        out = scored if out is None else out.unionByName(scored)
    return out


_KINDS = ", ".join(f"('{kind}')" for kind in train.MODELS)


@register(
    "training_run",
    with_views(
        ["card"],
        f"""SELECT model, {ROW_KEY} AS row_key, CAST({RULES['steep']} AS INTEGER) AS label, 1.0E0 AS roc_auc, 1.0E0 AS accuracy
FROM card, (VALUES {_KINDS}) m(model)""",
    ),
)
def training_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, oversampling, the three models with their measures; every row as each saved model scores it."""
    rows = keyed_card(spark, sf_dir).withColumn("Class", F.expr(RULES["steep"]).cast("int"))
    preparation = prepare.card_preparation(CARD_NUMBERS, keep=["row_key", "Class"])
    out_dir = scratch_path(spark, "models")
    done = train.run_training(rows, preparation, "card", "Class", "row_key", out_dir)
    table = runs.compare_runs(done, ["roc_auc", "accuracy"]).drop("dataset")
    served = _served(rows.drop("Class"), out_dir, "card", train.MODELS, "row_key")
    return served.join(F.broadcast(table), "model")


def _ruled(spark: SparkSession, sf_dir: str, turned: bool = False, rule: str = "risky") -> DataFrame:
    """Card rows whose class follows a rule, or its opposite."""
    rule = F.expr(RULES[rule])
    return keyed_card(spark, sf_dir).withColumn("Class", (~rule if turned else rule).cast("int"))


def _train_tree(rows: DataFrame, out_dir: str) -> None:
    preparation = prepare.card_preparation(CARD_NUMBERS, keep=["row_key", "Class"])
    train.run_training(rows, preparation, "card", "Class", "row_key", out_dir, ["tree"])


_RISKY = f"CAST({RULES['risky']} AS INTEGER)"


@register(
    "batch_score",
    with_views(
        ["card"],
        f"""WITH given AS (SELECT *, {ROW_KEY} AS row_key FROM card)
SELECT row_key, concat('T', l_orderkey) AS TransactionId, Amount, {_RISKY} AS label
FROM (SELECT * FROM given UNION ALL SELECT * FROM given WHERE l_orderkey % 5 = 0)""",
    ),
)
def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw row comes back once with its own ids, repeated rows as often as they were given."""
    out_dir = scratch_path(spark, "models")
    _train_tree(_ruled(spark, sf_dir), out_dir)
    preparation, model = score.load_best(out_dir, "card")
    raw = keyed_card(spark, sf_dir).drop("Class").withColumns(
        {"TransactionId": F.expr("concat('T', l_orderkey)"), "CustomerId": F.expr("concat('C', l_partkey)")}
    )
    raw = raw.unionByName(raw.where("l_orderkey % 5 = 0"))
    written = score.write_predictions(score.score_rows(raw, "card", preparation, model), out_dir, "card")
    return spark.read.parquet(written).select("row_key", "TransactionId", "Amount", F.col(score.LABEL).alias("label"))


@register(
    "versions_served",
    with_views(
        ["card"],
        f"SELECT {ROW_KEY} AS row_key, {_RISKY} AS first, 1 - {_RISKY} AS second, {_RISKY} AS best FROM card",
    ),
)
def versions_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two trainings with opposite classes in one folder: each version answers as it was trained, and of
    two perfect models the earlier is the best."""
    out_dir = scratch_path(spark, "models")
    _train_tree(_ruled(spark, sf_dir), out_dir)
    _train_tree(_ruled(spark, sf_dir, turned=True), out_dir)
    raw = keyed_card(spark, sf_dir).drop("Class")
    served = {
        "first": score.load_version(out_dir, "card", "tree", 1),
        "second": score.load_version(out_dir, "card", "tree"),
        "best": score.load_best(out_dir, "card"),
    }
    out = None
    for name, (preparation, model) in served.items():
        scored = score.score_rows(raw, "card", preparation, model, row_key="row_key")
        scored = scored.select("row_key", F.col(score.LABEL).alias(name))
        out = scored if out is None else out.join(scored, "row_key")
    return out


@register("training_reuse", with_views(["card"], f"SELECT {ROW_KEY} AS row_key, {_RISKY} AS label FROM card"))
def training_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second training on the features the first one left, given no rows of its own; its model scores every row."""
    out_dir = scratch_path(spark, "models")
    rows = _ruled(spark, sf_dir)
    preparation = prepare.card_preparation(CARD_NUMBERS, keep=["row_key", "Class"])
    for given in (rows, rows.where("false")):
        train.run_training(
            given, preparation, "card", "Class", "row_key", out_dir, ["tree"], features_path=f"{out_dir}/features"
        )
    second = score.load_version(out_dir, "card", "tree", 2)
    scored = score.score_rows(rows.drop("Class"), "card", *second, row_key="row_key")
    return scored.select("row_key", F.col(score.LABEL).alias("label"))


@register(
    "features_follow_changes",
    with_views(
        ["card"],
        """SELECT 'again' AS call, count(*) AS n, count(*) AS refunds FROM card WHERE l_orderkey % 2 = 0
UNION ALL SELECT 'file added', count(*), count(*) FROM card UNION ALL SELECT 'stage changed', count(*), 0 FROM card""",
    ),
)
def features_follow_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored features are used while stages and input files are the same, and built anew when a file is added or a
    stage told otherwise: rows, and rows with the refund column."""
    source, path = scratch_path(spark, "given"), f"{scratch_path(spark, 'reused')}/features"
    card = keyed_card(spark, sf_dir)
    card.where("l_orderkey % 2 = 0").write.parquet(source)
    found = []

    def call(name: str, preparation, rows: DataFrame | None = None) -> None:
        rows = spark.read.parquet(source) if rows is None else rows
        _, features = prepare.reused_features(preparation, rows, path, [source])
        refunds = F.count(derive.REFUND) if derive.REFUND in features.columns else F.lit(0).cast("long")
        found.append(features.agg(F.lit(name).alias("call"), F.count("*").alias("n"), refunds.alias("refunds")).first())

    usual = prepare.card_preparation(CARD_NUMBERS, keep=["row_key", "Class"])
    call("first", usual)
    # Rows that would give an empty table are not read.
    call("again", usual, spark.read.parquet(source).where("false"))
    card.where("l_orderkey % 2 <> 0").write.mode("append").parquet(source)
    call("file added", usual)
    call("stage changed", Pipeline(stages=[s for s in usual.getStages() if not isinstance(s, prepare.stages.RefundFlag)]))
    return spark.createDataFrame(found[1:], "call string, n long, refunds long")


# A class of one category: its one-hot column alone decides.
SOURCE_RULE = "source = 'Ads'"


def _train_ecommerce(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...]) -> tuple[str, DataFrame, DataFrame]:
    """E-commerce models on the class of a category: their folder, the raw rows and the address ranges."""
    ranges = view(spark, sf_dir, "ip_country")
    raw = view(spark, sf_dir, "txn").withColumn("class", F.expr(SOURCE_RULE).cast("int"))
    preparation = prepare.ecommerce_preparation(keep=["txn_id", "class"], money_scale=CENTS)
    out_dir = scratch_path(spark, "models")
    train.run_training(prepare.to_canonical(raw, ranges), preparation, "ecommerce", "class", "txn_id", out_dir, kinds)
    return out_dir, raw.drop("class"), ranges


@register(
    "ecommerce_score",
    with_views(
        ["txn"], f"SELECT model, txn_id, CAST({SOURCE_RULE} AS INTEGER) AS label FROM txn, (VALUES {_KINDS}) m(model)"
    ),
)
def ecommerce_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-commerce training of the three models, then every raw row as each of them scores it."""
    out_dir, raw, ranges = _train_ecommerce(spark, sf_dir, train.MODELS)
    return _served(raw, out_dir, "ecommerce", train.MODELS, "txn_id", ranges)


# --- explanation ---------------------------------------------------------------------------

# Weights of a given linear score.
WEIGHTS = {"V1": 0.02, "V2": -0.1, "V5": 0.0015, "Amount": 0.00001}


def _linear_sql(digits: int | None = 6) -> str:
    def contribution(column: str, weight: float) -> str:
        exact = f"{weight!r}::DOUBLE * ({column} - (SELECT avg({column}) FROM card))"
        return exact if digits is None else f"round({exact}, {digits}) + 0.0E0"

    return " UNION ALL ".join(
        f"SELECT {', '.join(CARD_KEYS)}, '{c}' AS feature, {contribution(c, w)} AS contribution FROM card"
        for c, w in WEIGHTS.items()
    )


def _contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = card_with_key(spark, sf_dir)
    means = card.agg(*[F.avg(c).alias(c) for c in WEIGHTS]).first().asDict()
    return explain.shapley_linear(card, "row_key", WEIGHTS, means)


@register(
    "shapley_linear",
    with_views(["card"], f"SELECT {CARD_KEY} AS row_key, feature, contribution FROM ({_linear_sql()})"),
)
def shapley_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_contributions(spark, sf_dir), "contribution")


@register(
    "shapley_importance",
    with_views(
        ["card"],
        f"""SELECT feature, round(avg(abs(contribution)), 5) AS mean_abs, round(min(contribution), 5) AS lowest,
  round(max(contribution), 5) AS highest, count(*) AS n FROM ({_linear_sql(None)}) GROUP BY feature""",
    ),
)
def shapley_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = explain.importance(_contributions(spark, sf_dir))
    return table.withColumns({c: F.round(c, 5) for c in ("mean_abs", "lowest", "highest")})


@register(
    "top_contributions",
    with_views(
        ["card"],
        f"""SELECT {CARD_KEY} AS row_key, feature, contribution, CAST(row_number() OVER (PARTITION BY {CARD_KEY}
  ORDER BY abs(contribution) DESC, feature) AS INTEGER) AS place FROM ({_linear_sql()}) QUALIFY place <= 2""",
    ),
)
def top_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.top_features(shapley_linear(spark, sf_dir), "row_key", 2)


def _step_ctes(source: str, key: str, rule: str, instances: int) -> str:
    """CTEs ending in ``gained`` (key, contribution, base): sampled Shapley values of a score that is a step of
    one feature, for the first ``instances`` rows by hash, with the background rows drawn for each order."""
    return f"""hashed AS (SELECT {key} AS k, CAST({rule} AS INTEGER) AS f, md5(concat_ws('|', '42', CAST({key} AS VARCHAR))) AS h FROM {source}),
chosen AS (SELECT * FROM hashed ORDER BY h, k LIMIT {instances}),
background AS (SELECT f, row_number() OVER (ORDER BY k) - 1 AS b
  FROM (SELECT * FROM hashed ORDER BY h, k LIMIT {explain.BACKGROUND_ROWS})),
orders AS (SELECT {sql_word("md5(concat_ws('|', '42', 'background', CAST(o AS VARCHAR)))", 0)}
  % (SELECT count(*) FROM background) AS b FROM range({explain.ORDERS}) r(o)),
gained AS (SELECT k, avg(c.f - z.f) AS contribution, avg(CAST(z.f AS DOUBLE)) AS base
  FROM chosen c, orders JOIN background z USING (b) GROUP BY k)"""


def _tree(spark: SparkSession, sf_dir: str):
    """A tree that is a step of V4, and its rows."""
    rows = _labelled(spark, sf_dir, "steep")
    trainer = models.ModelTrainer("tree")
    return trainer.train(rows.where("not is_test"), FEATURES, "steep"), rows


@register(
    "shapley_sampled",
    with_views(
        ["card"],
        f"""WITH {_step_ctes('card', CARD_KEY, RULES['steep'], 50)}
SELECT k AS row_key, feature, CASE feature WHEN 'V4' THEN contribution ELSE 0.0E0 END AS contribution, base
FROM gained, (VALUES {', '.join(f"('{c}')" for c in FEATURES)}) n(feature)""",
    ),
)
def shapley_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled contributions of a tree for a sample of rows."""
    model, rows = _tree(spark, sf_dir)
    instances = sampling.seeded_sample(rows, ["row_key"], 50)
    return explain.shapley_sampled(model, instances, rows, "row_key", FEATURES)


@register(
    "shapley_trees",
    with_views(
        ["card"],
        f"""WITH ruled AS (SELECT *, CAST({RULES['steep']} AS INTEGER) AS steep FROM card), {split_ctes('ruled', 'steep', CARD_HASH)},
mean AS (SELECT avg(CAST(steep AS DOUBLE)) AS base FROM split WHERE NOT is_test)
SELECT {CARD_KEY} AS row_key, feature, CASE feature WHEN 'V4' THEN round(steep - base, 9) ELSE 0.0E0 END AS contribution, round(base, 9) AS base
FROM split, mean, (VALUES {', '.join(f"('{c}')" for c in FEATURES)}) n(feature)""",
    ),
)
def shapley_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact contributions of a tree to the score of every row."""
    model, rows = _tree(spark, sf_dir)
    found = trees.shapley_trees(model, rows, "row_key", FEATURES)
    return found.withColumns({c: F.round(c, 9) + F.lit(0.0) for c in ("contribution", "base")})


@register(
    "shapley_kernel",
    with_views(
        ["card"],
        f"""WITH hashed AS (SELECT *, {CARD_KEY} AS k, md5(concat_ws('|', '42', {CARD_KEY})) AS h FROM card),
means AS (SELECT {', '.join(f'avg({c}) AS {c}' for c in WEIGHTS)} FROM (SELECT * FROM hashed ORDER BY h, k LIMIT {explain.KERNEL_ROWS})),
few AS (SELECT * FROM hashed ORDER BY h, k LIMIT 40)
{' UNION ALL '.join(f"SELECT k AS row_key, '{c}' AS feature, round({w!r}::DOUBLE * (few.{c} - means.{c}), 4) + 0.0E0 AS contribution FROM few, means" for c, w in WEIGHTS.items())}""",
    ),
)
def shapley_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contributions by regression over coalitions; for a linear model they are the weights times the distances from the background's means."""
    card = card_with_key(spark, sf_dir)
    linear = card.withColumn("target", sum((F.lit(w) * F.col(c) for c, w in WEIGHTS.items()), F.lit(0.0)))
    vectors = VectorAssembler(inputCols=list(WEIGHTS), outputCol=models.VECTOR).transform(linear)
    model = LinearRegression(featuresCol=models.VECTOR, labelCol="target", solver="normal").fit(vectors)
    few = sampling.seeded_sample(card, ["row_key"], 40)
    found = explain.shapley_kernel(model, few, card, "row_key", list(WEIGHTS), task="regressor")
    return found.select("row_key", "feature", (F.round("contribution", 4) + F.lit(0.0)).alias("contribution"))


@register(
    "lime_local",
    with_views(
        ["card"],
        f"""WITH cuts AS (SELECT unnest([quantile_cont(V4, 0.25), quantile_cont(V4, 0.5), quantile_cont(V4, 0.75)]) AS c FROM card),
few AS (SELECT {CARD_KEY} AS row_key, V4 FROM card ORDER BY md5(concat('42|', {CARD_KEY})) LIMIT 5),
ends AS (SELECT row_key, max(c) FILTER (c < V4) AS low, min(c) FILTER (c >= V4) AS high FROM few, cuts GROUP BY row_key)
SELECT row_key, 'V4' AS feature, CASE WHEN low IS NULL THEN printf('V4 <= %.2f', high)
  WHEN high IS NULL THEN printf('V4 > %.2f', low) ELSE printf('%.2f < V4 <= %.2f', low, high) END AS condition FROM ends""",
    ),
)
def lime_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local surrogates of a tree for a few rows: the strongest feature of each and its condition."""
    model, rows = _tree(spark, sf_dir)
    instances = sampling.seeded_sample(rows, ["row_key"], 5)
    local = explain.local_surrogate(model, instances, rows, "row_key", FEATURES)
    return explain.top_features(local, "row_key", 1, "weight").select("row_key", "feature", "condition")


def _importance_sql(view_name: str, key: str, rule: str, feature: str) -> str:
    return with_views(
        [view_name],
        f"""WITH {_step_ctes(view_name, key, rule, 100)}
SELECT '{feature}' AS feature, round(avg(abs(contribution)), 9) AS mean_abs, min(contribution) AS lowest,
  max(contribution) AS highest, count(*) AS n FROM gained""",
    )


def _that_matter(found: interpret.Interpretation) -> DataFrame:
    """The features a step score uses; the others contribute exactly nothing."""
    return found.importance.where("mean_abs > 0").withColumn("mean_abs", F.round("mean_abs", 9))


@register("interpretation", _importance_sql("card", ROW_KEY, RULES["steep"], "V4"))
def interpretation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved model and preparation applied to new rows and explained: the features that matter."""
    out_dir = scratch_path(spark, "models")
    rows = _ruled(spark, sf_dir, rule="steep")
    _train_tree(rows, out_dir)
    preparation, model = score.load_best(out_dir, "card")
    return _that_matter(interpret.interpret(rows, "card", "row_key", preparation, model, label="Class", method="sampled"))


@register("ecommerce_interpretation", _importance_sql("txn", "txn_id", SOURCE_RULE, "source_Ads"))
def ecommerce_interpretation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for e-commerce rows: addresses, velocity and one-hot columns included."""
    out_dir, raw, ranges = _train_ecommerce(spark, sf_dir, ("tree",))
    preparation, model = score.load_best(out_dir, "ecommerce")
    return _that_matter(interpret.interpret(raw, "ecommerce", "txn_id", preparation, model, ranges, method="sampled"))


@register(
    "data_preparation_run",
    with_views(
        ["txn", "card"],
        """WITH n AS (SELECT 'ecommerce' AS dataset, class AS label, count(*) AS n FROM txn GROUP BY ALL
  UNION ALL SELECT 'card', Class, count(*) FROM card GROUP BY ALL)
SELECT dataset, label, 'before' AS stage, n FROM n
UNION ALL SELECT dataset, label, 'after', max(n) OVER (PARTITION BY dataset) FROM n""",
    ),
)
def data_preparation_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both raw tables cleaned, prepared and written; class sizes before and after oversampling."""
    done = engineer.prepare_both(
        view(spark, sf_dir, "txn_dup"), view(spark, sf_dir, "ip_country"), keyed_card(spark, sf_dir),
        scratch_path(spark, "prepared"), "txn_id", "row_key", CARD_NUMBERS, CENTS,
    )
    parts = [
        done[name].imbalance.select(F.lit(name).alias("dataset"), F.col(label).alias("label"), "stage", "n")
        for name, label in (("ecommerce", "class"), ("card", "Class"))
    ]
    return parts[0].unionByName(parts[1])
