"""Text classifiers: messages with personal data, and five moderation labels."""
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    IDF, HashingTF, StandardScaler, StopWordsRemover, Tokenizer, Word2Vec,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import settled
from ..operators.network import Network, fit_network, with_chances
from ..operators.sampling import (
    balanced_split, bernoulli_sample, first_by_hash, hash_split, hash_uniform,
)
from .harm import MESSAGE_LABELS


@dataclass
class Fitted:
    """A fitted model with its scored test rows."""
    model: PipelineModel
    predictions: DataFrame

    def metrics(self) -> DataFrame:
        """Accuracy, weighted precision and recall, one row."""
        return classification_metrics(self.predictions)

    def area_under_roc(self) -> float:
        return BinaryClassificationEvaluator(
            labelCol="label", rawPredictionCol="rawPrediction",
            metricName="areaUnderROC").evaluate(self.predictions)


def classification_metrics(predictions: DataFrame, by=()) -> DataFrame:
    """Accuracy, weighted precision and weighted recall from one confusion count."""
    cells = predictions.groupBy(
        *by, F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction")).agg(F.count("*").alias("n"))
    sides = cells.select(*by, "n", F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.lit(1).alias("actual"), F.lit(0).alias("predicted"),
                 (F.col("label") == F.col("prediction")).cast("int").alias("right")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).alias("actual"),
                 F.lit(1).alias("predicted"), F.lit(0).alias("right")))).alias("s"))
    n = F.col("n")
    classes = sides.groupBy(*by, "s.class").agg(
        F.sum(n * F.col("s.actual")).alias("actual"),
        F.sum(n * F.col("s.predicted")).alias("predicted"),
        F.sum(n * F.col("s.right")).alias("right"))
    precision = F.coalesce(F.try_divide(F.col("right"), F.col("predicted")), F.lit(0.0))
    return classes.groupBy(*by).agg(
        F.sum("actual").alias("rows"),
        (F.sum("right") / F.sum("actual")).alias("accuracy"),
        (F.sum(precision * F.col("actual")) / F.sum("actual")).alias("weighted_precision"),
        # Weighted by class size, recall adds up to the accuracy.
        (F.sum("right") / F.sum("actual")).alias("weighted_recall"))


def draw_messages(messages: DataFrame, flag: str = "redacted", train: int = 5000, test: int = 1000,
                  content: str = "content", seed: int = 42) -> DataFrame:
    """Balanced training and test messages with a 0/1 label, disjoint in content.

    Messages whose flag is NULL belong to neither class. The draw, a few thousand
    messages, is stored: fitting and scoring then never go back to the log.
    """
    labelled = messages.filter(F.col(flag).isNotNull()).select(
        content, F.when(F.col(flag), 1).otherwise(0).alias("label"))
    return settled(balanced_split(labelled, "label", [0, 1], train, test, content, seed))


def text_feature_stages(content: str = "content", without_stop_words: bool = False,
                        buckets: int = 10000, scale: bool = False) -> list:
    """Tokens, hashed term frequencies, inverse document frequency, scaling."""
    tokens = Tokenizer(inputCol=content, outputCol="words")
    stages, words = [tokens], "words"
    if without_stop_words:
        stages.append(StopWordsRemover(inputCol=words, outputCol="clean_words"))
        words = "clean_words"
    stages += [
        HashingTF(inputCol=words, outputCol="raw_features", numFeatures=buckets),
        IDF(inputCol="raw_features", outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled_features",
                       withMean=False, withStd=True),
    ]
    return stages if scale else stages[:-1]


def _dealt(rows: DataFrame, partitions: int | None) -> DataFrame:
    return rows if partitions is None else rows.repartition(partitions)


def fit_flag_classifier(drawn: DataFrame, max_iter: int = 10, use_scaled: bool = False,
                        without_stop_words: bool = False, content: str = "content",
                        partitions: int | None = None) -> Fitted:
    """Logistic regression on the drawn messages; everything is fitted on the train part.

    ``partitions`` deals a small draw to few tasks, which pass it fastest.
    """
    stages = text_feature_stages(content, without_stop_words, scale=use_scaled)
    features = "scaled_features" if use_scaled else "features"
    train = _dealt(drawn.filter("part = 'train'"), partitions).persist()
    try:
        model = Pipeline(stages=[
            *stages, LogisticRegression(featuresCol=features, labelCol="label", maxIter=max_iter),
        ]).fit(train)
    finally:
        train.unpersist()
    return Fitted(model, model.transform(drawn.filter("part = 'test'")))


def tune_flag_classifier(drawn: DataFrame, max_iters=(10, 50, 100), reg_params=(0.01, 0.1, 1.0),
                         elastic_nets=(0.0, 0.5, 1.0), folds: int = 5, parallelism: int = 4,
                         content: str = "content", seed: int = 42) -> Fitted:
    """Grid search by area under the ROC curve, then scoring of the test part.

    Features are fitted once on the training part; folds are fixed by content, so the
    search gives the same answer on any cluster.
    """
    train = drawn.filter("part = 'train'")
    features = Pipeline(stages=text_feature_stages(content)).fit(train)
    regression = LogisticRegression(featuresCol="features", labelCol="label")
    grid = (
        ParamGridBuilder()
        .addGrid(regression.maxIter, list(max_iters))
        .addGrid(regression.regParam, list(reg_params))
        .addGrid(regression.elasticNetParam, list(elastic_nets))
        .build()
    )
    fold = F.floor(hash_uniform([content], seed + 1) * folds).cast("int")
    prepared = features.transform(train).select("features", "label", fold.alias("fold")).persist()
    try:
        search = CrossValidator(
            estimator=regression, estimatorParamMaps=grid, numFolds=folds, foldCol="fold",
            parallelism=parallelism,
            evaluator=BinaryClassificationEvaluator(
                labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC"),
        ).fit(prepared)
    finally:
        prepared.unpersist()
    best = PipelineModel(stages=[*features.stages, search.bestModel])
    return Fitted(best, best.transform(drawn.filter("part = 'test'")))


def best_parameters(fitted: Fitted) -> dict[str, float]:
    """maxIter, regParam and elasticNetParam of the regression in use."""
    regression = fitted.model.stages[-1]
    return {"maxIter": regression.getMaxIter(), "regParam": regression.getRegParam(),
            "elasticNetParam": regression.getElasticNetParam()}


def draw_labelled_messages(messages: DataFrame, keys, per_label: int = 1000,
                           seed: int = 42) -> DataFrame:
    """Up to ``per_label`` messages of each label, and as many not toxic ones.

    A message with several labels may be drawn once for each. ``keys`` identify a
    message. The draw is stored.
    """
    classes = F.array(
        F.when(~F.col("toxic"), F.lit("not_toxic")),
        *[F.when(F.col(name) == 1, F.lit(name)) for name in MESSAGE_LABELS])
    by_class = messages.select("*", F.explode(
        F.filter(classes, lambda c: c.isNotNull())).alias("drawn_for"))
    names = ["not_toxic", *MESSAGE_LABELS]
    return settled(first_by_hash(by_class, "drawn_for", names, per_label, keys, seed).drop("draw"))


def embed_messages(drawn: DataFrame, keys, fraction: float = 0.1, size: int = 100, min_count: int = 5,
                   seed: int = 42) -> DataFrame:
    """Mean word vectors of a sample of drawn messages, split 80/10/10 in ``part``.

    Word2Vec keeps its vocabulary on the driver, which the draw bounds; one task trains
    on about 20,000 texts.
    """
    words = drawn.withColumn("content_array", F.split("content", " "))
    clean = StopWordsRemover(inputCol="content_array", outputCol="clean_content").transform(words)
    sampled = bernoulli_sample(clean, fraction, [*keys, "drawn_for"], seed)
    sampled = hash_split(sampled, {"train": 0.8, "validation": 0.1, "test": 0.1}, [*keys, "drawn_for"], seed + 1)
    vectors = Word2Vec(inputCol="clean_content", outputCol="features", vectorSize=size,
                       minCount=min_count, seed=seed, numPartitions=1 + sampled.count() // 20_000)
    return vectors.fit(sampled).transform(sampled)


def network(width: int, hidden=(256, 128), max_iter: int = 100, seed: int = 42):
    """The layered network of the label classifiers."""
    return MultilayerPerceptronClassifier(layers=[width, *hidden, 2], maxIter=max_iter, seed=seed)


def regression(width: int, max_iter: int = 100):
    """A linear alternative to the network."""
    return LogisticRegression(maxIter=max_iter)


def fit_label_classifiers(embedded: DataFrame, estimator=network, partitions: int | None = None) -> DataFrame:
    """One classifier per label; its metrics on the test part, one row per label.

    ``estimator`` makes an unfitted classifier for a feature width. Labels with a
    single class in the training part cannot be learnt and are left out. All labels
    are scored in one pass over the test part. ``partitions`` deals a small draw to few
    tasks, which pass the iterations fastest.
    """
    train = embedded.filter("part = 'train'").select("features", *MESSAGE_LABELS)
    train = _dealt(train, partitions).persist()
    scored, learnt = embedded.filter("part = 'test'").select("features", *MESSAGE_LABELS), []
    try:
        seen = train.agg(
            F.count("*").alias("n"), F.first(F.size(vector_to_array("features"))).alias("width"),
            *[F.sum(c).alias(c) for c in MESSAGE_LABELS]).first()
        for name in MESSAGE_LABELS:
            if seen[name] in (None, 0, seen["n"]):
                continue
            model = estimator(seen["width"]).setParams(
                featuresCol="features", labelCol=name, predictionCol=f"said_{name}",
                rawPredictionCol=f"raw_{name}", probabilityCol=f"chance_{name}").fit(train)
            scored = model.transform(scored).drop(f"raw_{name}", f"chance_{name}")
            learnt.append(name)
    finally:
        train.unpersist()
    pairs = [
        F.struct(F.lit(name).alias("label_name"), F.col(name).cast("int").alias("label"),
                 F.col(f"said_{name}").cast("int").alias("prediction")) for name in learnt]
    empty = F.array().cast("array<struct<label_name:string,label:int,prediction:int>>")
    return binary_metrics(scored.select(F.inline(F.array(*pairs) if pairs else empty)))


@dataclass
class FittedLabels:
    """The label network with the test rows and the chances it gives them."""
    network: Network
    predictions: DataFrame

    def metrics(self) -> DataFrame:
        """Log loss, accuracy, precision and recall of every label on the test rows."""
        pairs = F.array(*[
            F.struct(F.lit(name).alias("label_name"), F.col(name).cast("int").alias("label"),
                     F.col(f"chance_{name}").alias("chance")) for name in self.network.labels])
        scored = self.predictions.select(F.inline(pairs)).filter("label IS NOT NULL AND chance IS NOT NULL")
        surprise = -F.ln(F.greatest(F.when(F.col("label") == 1, F.col("chance")).otherwise(1 - F.col("chance")), F.lit(1e-7)))
        scored = scored.withColumn("prediction", (F.col("chance") >= 0.5).cast("int")).withColumn("surprise", surprise)
        return binary_metrics(scored, F.avg("surprise").alias("loss"))

    def history(self, spark) -> DataFrame:
        """Summed log loss of the labels on training and validation rows, per pass."""
        rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(self.network.steps, 1)]
        return spark.createDataFrame(rows, "step long, train_loss double, validation_loss double")


def fit_label_network(embedded: DataFrame, hidden=(256, 128), drop=(0.3, 0.2), steps: int = 300,
                      rate: float = 0.01, patience: int = 60, seed: int = 42) -> FittedLabels:
    """One network for all labels: shared hidden layers, an output and a log loss per label.

    The weights are those with the lowest loss on the validation part; the metrics come from
    the test part. Unknown labels are neither learnt from nor counted.
    """
    rows = embedded.withColumn("features", vector_to_array("features"))
    network = fit_network(rows, "features", list(MESSAGE_LABELS), hidden, drop, steps, rate, patience, seed)
    return FittedLabels(network, with_chances(rows.filter("part = 'test'"), network, "features"))


def binary_metrics(scored: DataFrame, *more) -> DataFrame:
    """Accuracy, precision and recall of the positive class per label."""
    positive, said = F.col("label") == 1, F.col("prediction") == 1
    return scored.groupBy("label_name").agg(
        F.count("*").alias("rows"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
        F.coalesce(F.try_divide(F.count_if(positive & said), F.count_if(said)), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(F.count_if(positive & said), F.count_if(positive)), F.lit(0.0)).alias("recall"), *more)
