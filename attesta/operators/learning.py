"""The lead ranker: dataset, training, scoring and metrics."""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from attesta.functions.labels import CATEGORICAL_FEATURES, NUMERIC_FEATURES, candidate_features, candidate_labels
from attesta.functions.urls import host
from attesta.operators.ordering import running_totals, with_totals
from attesta.operators.sampling import grouped_split
from attesta.session import fixed, settle, spread


def ranker_dataset(register: DataFrame, resolvable: DataFrame, variants: int = 6) -> DataFrame:
    """Guessed hosts that resolve, labelled against the register's own site.

    ``resolvable`` is (host). A guess with the true label under another ending is the
    same entity, so it is marked as no fair negative.
    """
    truth = host(F.when(F.contains("website", F.lit("://")), F.col("website")).otherwise(F.concat(F.lit("http://"), "website")))
    known = spread(register, "org").withColumn("truth", truth).filter(F.col("truth") != "")
    guesses = known.select("*", F.posexplode(candidate_labels(F.col("name"), variants)).alias("turn", "label_text"))
    hosts = guesses.select("*", F.posexplode(F.array(F.lit(".no"), F.lit(".com"))).alias("ending_turn", "ending"))
    hosts = hosts.withColumns({"candidate": F.concat("label_text", "ending"), "listed_rank": F.col("turn") * 2 + F.col("ending_turn") + 1})
    alive = fixed(hosts).join(resolvable.select(F.col("host").alias("candidate")).distinct(), "candidate")
    positive = F.col("candidate") == F.col("truth")
    truth_label = F.substring_index("truth", ".", 1)
    made = candidate_features(F.col("name"), F.col("candidate"), F.col("employees"), F.col("legal_form"), F.col("bankrupt"), F.col("latest_submitted_accounts"))
    weight = F.col("stratum_weight") if "stratum_weight" in register.columns else F.lit(1.0)
    return alive.select(
        "org", "candidate", "truth", positive.cast("int").alias("label"), (~positive & (F.col("label_text") == truth_label)).cast("int").alias("excluded_negative"),
        "listed_rank", weight.alias("stratum_weight"), made.alias("features"),
    )


class RankerModel:
    """Standardised logistic scores with a Platt step; plain numbers, so scoring is column arithmetic."""

    def __init__(self, names: list[str], mean: list[float], std: list[float], weights: list[float], bias: float, platt_a: float, platt_b: float):
        self.names, self.mean, self.std, self.weights = names, mean, std, weights
        self.bias, self.platt_a, self.platt_b = bias, platt_a, platt_b

    def to_json(self) -> str:
        return json.dumps({
            "kind": "logreg_platt_v1", "numeric": NUMERIC_FEATURES, "categorical": CATEGORICAL_FEATURES, "feature_names": self.names, "mean": self.mean, "std": self.std,
            "weights": self.weights, "bias": self.bias, "platt_a": self.platt_a, "platt_b": self.platt_b,
        })

    @classmethod
    def from_json(cls, text: str) -> "RankerModel":
        blob = json.loads(text)
        if blob.get("kind") != "logreg_platt_v1":
            raise ValueError("not a ranker model")
        return cls(blob["feature_names"], blob["mean"], blob["std"], blob["weights"], blob["bias"], blob["platt_a"], blob["platt_b"])

    def linear(self, features: str = "features") -> Column:
        total = F.lit(float(self.bias))
        for name, mean, std, weight in zip(self.names, self.mean, self.std, self.weights):
            if "=" in name:
                column, value = name.split("=", 1)
                raw = F.when(F.col(f"{features}.{column}") == value, 1.0).otherwise(0.0)
            else:
                raw = F.coalesce(F.col(f"{features}.{name}").cast("double"), F.lit(0.0))
            total = total + (raw - F.lit(float(mean))) / F.lit(float(std)) * F.lit(float(weight))
        return total

    def probability(self, features: str = "features") -> Column:
        logit = F.lit(float(self.platt_a)) * self.linear(features) + F.lit(float(self.platt_b))
        return 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), logit))))


def train_ranker(dataset: DataFrame, seed: int = 20260925, test_share: float = 0.25, calibration_share: float = 0.2, l2: float = 1.0) -> tuple[RankerModel, DataFrame]:
    """Class-balanced weighted logistic regression, then Platt scaling on other entities.

    Returns the model and the held-out rows. Entities never straddle two slices.
    """
    flat = dataset.filter("excluded_negative = 0").select(
        "org", "candidate", F.col("label").cast("double").alias("label"), F.coalesce("stratum_weight", F.lit(1.0)).alias("w"), "features",
        *[F.col(f"features.{c}").cast("double").alias(f"n_{c}") for c in NUMERIC_FEATURES], *[F.col(f"features.{c}").alias(f"c_{c}") for c in CATEGORICAL_FEATURES],
    )
    # Training reads its rows many times; one reliable copy keeps those reads cheap.
    flat = settle(flat)
    split = settle(grouped_split(flat, seed, test_share))
    test = split.filter("is_test").drop("is_test")
    inner = settle(grouped_split(split.filter("NOT is_test").drop("is_test"), seed + 1, calibration_share))
    fit, calibration = inner.filter("NOT is_test").drop("is_test"), inner.filter("is_test").drop("is_test")

    balance = fit.agg(F.count(F.lit(1)).alias("n"), F.greatest(F.lit(1.0), F.sum("label")).alias("pos"), F.greatest(F.lit(1.0), F.sum(1 - F.col("label"))).alias("neg"))
    weighted = with_totals(fit, balance).withColumn("weight", F.col("w") * F.when(F.col("label") > 0.5, F.col("n") / (2 * F.col("pos"))).otherwise(F.col("n") / (2 * F.col("neg"))))
    indexers = [StringIndexer(inputCol=f"c_{c}", outputCol=f"i_{c}", handleInvalid="keep", stringOrderType="alphabetAsc").fit(weighted) for c in CATEGORICAL_FEATURES]
    encoder = OneHotEncoder(inputCols=[f"i_{c}" for c in CATEGORICAL_FEATURES], outputCols=[f"v_{c}" for c in CATEGORICAL_FEATURES], dropLast=True, handleInvalid="keep")
    assembler = VectorAssembler(inputCols=[f"n_{c}" for c in NUMERIC_FEATURES] + [f"v_{c}" for c in CATEGORICAL_FEATURES], outputCol="raw")

    encoded = weighted
    for indexer in indexers:
        encoded = indexer.transform(encoded)
    encoder_model = encoder.setDropLast(False).fit(encoded)
    encoded = settle(assembler.transform(encoder_model.transform(encoded)).select("label", "weight", "raw"))
    scaler = StandardScaler(inputCol="raw", outputCol="x", withMean=True, withStd=True).fit(encoded)
    size = encoded.count()
    trained = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", regParam=l2 / max(1, size), elasticNetParam=0.0, standardization=False, maxIter=100, tol=1e-7).fit(scaler.transform(encoded))

    names = list(NUMERIC_FEATURES)
    for column, indexer, width in zip(CATEGORICAL_FEATURES, indexers, encoder_model.categorySizes):
        labels = list(indexer.labels) + ["__unseen__"] * (width + 1 - len(indexer.labels))
        names += [f"{column}={value}" for value in labels]
    weights, mean, std = list(trained.coefficients), list(scaler.mean), list(scaler.std)
    names = (names + [f"pad={i}" for i in range(len(weights))])[: len(weights)]
    std = [float(s) if s > 1e-8 else 1.0 for s in std]
    kept = [i for i, n in enumerate(names) if not n.endswith("=__unseen__") and not n.startswith("pad=")]
    model = RankerModel([names[i] for i in kept], [float(mean[i]) for i in kept], [std[i] for i in kept], [float(weights[i]) for i in kept], float(trained.intercept), 1.0, 0.0)

    scored = VectorAssembler(inputCols=["z"], outputCol="zx").transform(calibration.withColumn("z", model.linear()))
    platt = LogisticRegression(featuresCol="zx", labelCol="label", regParam=0.0, standardization=False, maxIter=50).fit(scored)
    model.platt_a, model.platt_b = float(platt.coefficients[0]), float(platt.intercept)
    return model, test.select("org", "candidate", "label", "features")


def score_candidates(rows: DataFrame, model: RankerModel) -> DataFrame:
    return rows.withColumn("probability", F.round(model.probability(), 4))


def ranker_metrics(scored: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """One row: ROC-AUC with tied ranks, average precision, calibration error, class counts.

    Rows with equal scores are folded into one before any ordering, so a score that a
    third of all rows share costs nothing; a tie is one step of the precision curve.
    """
    folded = scored.groupBy(F.col(score).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
    up = running_totals(folded, ["s"], ["n", "pos"])
    totals = folded.agg(F.sum("n").alias("rows"), F.sum("pos").alias("positives"))
    j = with_totals(up, totals)
    # Average rank of a tie group, and the counts at or above its score.
    rank_sum = F.sum(F.col("pos") * (F.col("c_n") - F.col("n") + (F.col("n") + 1) / 2))
    above = F.col("rows") - F.col("c_n") + F.col("n")
    above_pos = F.col("positives") - F.col("c_pos") + F.col("pos")
    steps = F.sum(F.col("pos") * above_pos / above)
    curves = j.groupBy("rows", "positives").agg(rank_sum.alias("rank_sum"), steps.alias("steps"))
    bins = scored.groupBy(F.least(F.lit(9), F.floor(F.col(score) * 10)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("rate"), F.avg(score).alias("mean_score")
    )
    gap = bins.agg(F.sum(F.col("n") * F.abs(F.col("rate") - F.col("mean_score"))).alias("gap"))
    p, q = F.col("positives"), F.col("rows") - F.col("positives")
    return with_totals(curves, gap).select(
        "rows", "positives", F.when((p > 0) & (q > 0), (F.col("rank_sum") - p * (p + 1) / 2) / (p * q)).alias("roc_auc"),
        (F.col("steps") / F.greatest(F.lit(1), p)).alias("average_precision"), (F.col("gap") / F.col("rows")).alias("ece"),
    )


def threshold_table(scored: DataFrame, label: str = "label", score: str = "probability", thresholds: tuple = (0.5, 0.6, 0.7, 0.8, 0.9)) -> DataFrame:
    """Precision, recall and published rows at each threshold, from one pass."""
    wide = scored.agg(
        F.sum(F.col(label).cast("long")).alias("all_pos"), *[F.count_if(F.col(score) >= t).alias(f"n_{i}") for i, t in enumerate(thresholds)],
        *[F.count_if((F.col(score) >= t) & (F.col(label) == 1)).alias(f"p_{i}") for i, t in enumerate(thresholds)],
    )
    rows = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"n_{i}").alias("published"), F.col(f"p_{i}").alias("hits")) for i, t in enumerate(thresholds)])
    return wide.select("all_pos", F.explode(rows).alias("r")).select(
        "r.threshold", "r.published", F.when(F.col("r.published") > 0, F.col("r.hits") / F.col("r.published")).alias("precision"),
        (F.col("r.hits") / F.greatest(F.lit(1), F.col("all_pos"))).alias("recall"),
    )


