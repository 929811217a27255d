"""Training rows, folds and models of expected outcomes."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlog.session import cut

FEATURES = ["down", "distance", "yardline_100", "quarter", "score_margin", "week", "is_home"]
#: Plays of either yards model.
YARDS = {"rush": "is_rush_attempt = 1 AND is_sack = 0", "pass": "is_dropback = 1"}
QUALITY = ["n", "auc", "log_loss", "brier", "n_rush", "rush_mae", "rush_rmse", "n_pass", "pass_mae", "pass_rmse"]
#: Seasons are left out one by one up to this number, else in so many groups; fits that run side by side.
SEASON_FOLDS, FITS = 10, 2


def training_rows(context: DataFrame, seasons: list[str] | None = None) -> DataFrame:
    """Dropbacks and rushes with all features known: keys, features, targets."""
    rows = context.where("is_dropback OR is_rush_attempt").withColumn("is_home", F.when(F.col("home_away") == "home", 1).otherwise(0))
    if seasons:
        rows = rows.where(F.col("season").isin(seasons))
    rows = rows.select("season", "game_id", "play_id", F.col("offense").alias("team"), *(F.col(c).cast("int").alias(c) for c in FEATURES), F.col("is_dropback").cast("int").alias("is_dropback"), F.col("is_rush_attempt").cast("int").alias("is_rush_attempt"), F.coalesce("is_sack", F.lit(False)).cast("int").alias("is_sack"), "yards_gained")
    return rows.dropna()


def season_folds(rows: DataFrame) -> DataFrame:
    """Leave one season out: a fold number for each season, in order."""
    return rows.select("season").distinct().withColumn("fold", F.dense_rank().over(Window.orderBy("season")).cast("bigint"))


def team_folds(rows: DataFrame, k: int = 5) -> DataFrame:
    """Teams dealt to k folds of like size, the largest first, back and forth; all rows of a team are in one fold."""
    teams = rows.groupBy("team").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.orderBy(F.col("n").desc(), "team")) - 1
    turn, at = F.floor(place / k) % 2, place % k
    return teams.select("team", "n", F.when(turn == 0, at).otherwise(k - 1 - at).cast("bigint").alias("fold"))


def _vectors(rows: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def fit_pass_model(rows: DataFrame, seed: int = 7):  # noqa: ANN201
    """Gradient-boosted trees for the chance of a dropback."""
    from pyspark.ml.classification import GBTClassifier

    return GBTClassifier(labelCol="is_dropback", maxIter=12, maxDepth=4, seed=seed).fit(_vectors(rows))


def fit_yards_models(rows: DataFrame, seed: int = 7) -> dict:
    """Expected yards of rushes (without sacks) and of dropbacks."""
    from pyspark.ml.regression import GBTRegressor

    fit = lambda where: GBTRegressor(labelCol="yards_gained", maxIter=10, maxDepth=4, seed=seed).fit(_vectors(rows.where(where)))
    return {kind: fit(where) for kind, where in YARDS.items()}


def _predicted(rows: DataFrame, pass_model, yards: dict) -> DataFrame:  # noqa: ANN001
    """The rows with xpass and the yards that either model expects, rush_yards and pass_yards."""
    from pyspark.ml.functions import vector_to_array

    out = pass_model.transform(_vectors(rows)).withColumn("xpass", vector_to_array("probability")[1]).drop("probability", "rawPrediction", "prediction")
    out = yards["rush"].transform(out).withColumnRenamed("prediction", "rush_yards")
    return yards["pass"].transform(out).withColumnRenamed("prediction", "pass_yards").drop("features")


def score_plays(rows: DataFrame, pass_model, yards: dict) -> DataFrame:  # noqa: ANN001
    """xpass, pass over expected, expected yards (the rush model for rush attempts, sacks included) and yards over expected."""
    out = _predicted(rows, pass_model, yards).withColumn("expected_yards", F.when(F.col("is_rush_attempt") == 1, F.col("rush_yards")).otherwise(F.col("pass_yards")))
    return out.select(*rows.columns, "xpass", (F.col("is_dropback") - F.col("xpass")).alias("pass_over_expected"), "expected_yards", (F.col("yards_gained") - F.col("expected_yards")).alias("yards_over_expected"))


def _fits(rows: DataFrame) -> bool:
    """Whether there are plays for all three models."""
    return all(rows.agg(*(F.count(F.when(F.expr(w), 1)) for w in YARDS.values())).first())


def quality(predicted: DataFrame, by: str) -> DataFrame:
    """AUC, log-loss and Brier score of xpass, MAE and RMSE of either yards model on its own plays, per value of ``by``; AUC from ranks, ties sharing them."""
    p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.col("xpass")))
    y = F.col("is_dropback")
    # Scores take few values: they are counted first, so the ranking window runs over values, not rows.
    values = predicted.groupBy(by, "xpass").agg(F.count("*").alias("n"), F.sum(y).alias("pos"))
    values = values.withColumn("below", F.coalesce(F.sum(F.col("n") - F.col("pos")).over(Window.partitionBy(by).orderBy("xpass").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    auc = values.groupBy(by).agg(F.expr("try_divide(sum(pos * (below + 0.5D * (n - pos))), sum(pos) * sum(n - pos))").cast("double").alias("auc"))
    errors = []
    for kind, where in YARDS.items():
        off = F.when(F.expr(where), F.col("yards_gained") - F.col(f"{kind}_yards"))
        errors += [F.count(off).alias(f"n_{kind}"), F.avg(F.abs(off)).alias(f"{kind}_mae"), F.sqrt(F.avg(off * off)).alias(f"{kind}_rmse")]
    rest = predicted.groupBy(by).agg(F.count("*").alias("n"), F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"), F.avg((y - F.col("xpass")) ** 2).alias("brier"), *errors)
    return rest.join(auc, by).select(by, *QUALITY)


def held_out_quality(rows: DataFrame) -> DataFrame:
    """Quality of the three models on plays they weren't fitted on: split, held_out and the columns of ``quality``.

    unseen_team: a model per team fold, fitted on the teams of the other folds; unseen_season: each season scored by a
    model that hasn't seen it (seasons dealt to SEASON_FOLDS groups where they are more). Of either also the plain mean
    of its rows. Where no plays for a fit are left, as with one season only, the metrics are null.
    """
    spark = rows.sparkSession
    seasons = season_folds(rows).select("season", ((F.col("fold") - 1) % SEASON_FOLDS).alias("unseen_season"))
    teams = team_folds(rows).select("team", F.col("fold").alias("unseen_team"))
    known = cut(rows.join(seasons, "season").join(teams, "team"))
    jobs = [(split, r[0]) for split in ("unseen_team", "unseen_season") for r in known.select(split).distinct().collect()]

    def measured(job: tuple[str, int]) -> list[tuple]:
        split, fold = job
        by = "season" if split == "unseen_season" else split
        here, others = known.where(F.col(split) == fold), known.where(F.col(split) != fold)
        if _fits(others):
            return [(split, str(r[0]), *r[1:]) for r in quality(_predicted(here, fit_pass_model(others), fit_yards_models(others)), by).collect()]
        return [(split, str(r[0]), r[1], *[None] * (len(QUALITY) - 1)) for r in here.groupBy(by).count().collect()]

    # Fits are chains of small jobs: some run side by side, as CrossValidator's do.
    with ThreadPool(FITS) as pool:
        got = [r for part in pool.map(inheritable_thread_target(spark)(measured), jobs, chunksize=1) for r in part]
    types = ", ".join(f"{c} {'bigint' if c.startswith('n') else 'double'}" for c in QUALITY)
    each = spark.createDataFrame(sorted(got, key=lambda r: r[:2]), f"split string, held_out string, {types}")
    mean = each.groupBy("split").agg(*((F.sum(c) if c.startswith("n") else F.avg(c)).alias(c) for c in QUALITY))
    return each.unionByName(mean.withColumn("held_out", F.lit("mean")))


def drive_features(context: DataFrame) -> DataFrame:
    """One row per drive: start, plays, early success, explosives, penalties, sacks, and whether it scored."""
    rows = context.where("drive_id IS NOT NULL AND offense <> ''")
    c = lambda x: F.sum(F.expr(f"CASE WHEN {x} THEN 1 ELSE 0 END")).cast("bigint")
    start = F.min_by("yardline_100", F.when(F.col("yardline_100").isNotNull(), F.col("play_id")))
    out = rows.groupBy("season", "run_id", "game_id", "drive_id", "offense").agg(start.alias("start"), c("is_pass_attempt OR is_rush_attempt").alias("plays"), c("is_success").alias("successes"), c("is_rush_attempt AND yards_gained >= 10 OR completion AND yards_gained >= 15").alias("explosives"), c("is_penalty").alias("penalties"), c("is_sack").alias("sacks"), F.max(F.expr("CASE WHEN offense_points > 0 THEN 1 ELSE 0 END")).alias("scored"))
    return out.dropna(subset=["start"])


def drive_logit(features: DataFrame) -> DataFrame:
    """Logistic regression of scoring on the drive features: of each the coefficient and odds ratio by standard deviation and by unit, and the p-value; McFadden's pseudo-R2.

    Beside it boosted trees as a cross-check, fitted on four fifths of the drives: importance, the rank of each feature
    under either model, and the AUC on the drives left out.
    """
    import math

    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    cols = ["start", "explosives", "penalties", "sacks"]
    v = VectorAssembler(inputCols=cols, outputCol="raw").transform(features)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(v)
    v = scaler.transform(v)
    m = GeneralizedLinearRegression(family="binomial", labelCol="scored", regParam=1e-9, maxIter=50).fit(v)
    odds = lambda b: math.exp(min(50.0, b))
    # A feature that never varies has no unit and a coefficient of 0.
    raw = [float(b) / sd if sd else 0.0 for b, sd in zip(m.coefficients, map(float, scaler.std), strict=True)]
    raw.append(float(m.intercept) - sum(b * float(x) for b, x in zip(raw, scaler.mean, strict=True)))
    both = [*map(float, m.coefficients), float(m.intercept)]
    p = list(m.summary.pValues)
    # The intercept's p-value is that of the standardised fit.
    pseudo = 1 - m.summary.deviance / m.summary.nullDeviance if m.summary.nullDeviance else None

    fifth = F.pmod(F.xxhash64("season", "run_id", "game_id", "drive_id", "offense"), F.lit(5)) == 0
    train, test = v.where(~fifth), v.where(fifth)
    importance, auc = [None] * len(cols), None
    if train.select("scored").distinct().count() == 2:
        trees = GBTClassifier(labelCol="scored", maxIter=20, maxDepth=3, seed=7).fit(train)
        importance = [float(x) for x in trees.featureImportances.toArray()]
        if test.select("scored").distinct().count() == 2:
            auc = BinaryClassificationEvaluator(labelCol="scored", numBins=0).evaluate(trees.transform(test))
    rank = lambda xs: [1 + sum(y > x for y in xs) for x in xs] if None not in xs else [None] * len(xs)
    ranks = zip(rank([abs(b) for b in both[:-1]]), importance, rank(importance), strict=True)
    extra = [*ranks, (None, None, None)]
    rows = [(c, b, odds(b), r, odds(r), float(q), pseudo, *x, auc) for c, b, r, q, x in zip([*cols, "intercept"], both, raw, p, extra, strict=True)]
    return features.sparkSession.createDataFrame(rows, "feature string, coefficient double, odds_ratio double, raw_coefficient double, raw_odds_ratio double, p_value double, pseudo_r2 double, logit_rank int, importance double, tree_rank int, holdout_auc double")
