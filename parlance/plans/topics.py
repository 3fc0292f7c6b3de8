"""Topics of conversation texts."""
import math
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words, and what is removed from texts before.
WORD_SEPARATORS = r"\W+|\d+"
# Every kept character is written out: Java looks them up in one table, ranges and \s take fifteen times as long.
PUNCTUATION = rf"[^{string.ascii_letters}{string.digits} \t\n\x0B\f\r]"


def full_texts(conversations: DataFrame, language: str | None = "English") -> DataFrame:
    """Add ``full_text``, the messages of a conversation joined by spaces."""
    if language is not None:
        conversations = conversations.filter(F.col("language") == language)
    return conversations.withColumn("full_text", F.concat_ws(" ", F.col("conversation.content")))


def dominant_topic(distribution="topicDistribution") -> Column:
    """Index of the largest topic weight, the first one of equals."""
    weights = vector_to_array(distribution)
    return (F.array_position(weights, F.array_max(weights)) - 1).cast("int")


def _digamma(x):
    """Derivative of the log gamma function, for positive values."""
    shift = sum(1 / (x + i) for i in range(10))
    y = 1 / (x + 10) ** 2
    series = y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))
    return np.log(x + 10) - 0.5 / (x + 10) - series - shift


def _log_gamma(x):
    return np.array([math.lgamma(v) for v in x.flat]).reshape(x.shape)


def _text_bounds(indices, counts, texts, gamma, alpha, log_beta):
    """Bound on the log likelihood of each text.

    ``indices``, ``counts`` and ``texts`` name the terms, how often, and the text they are in;
    ``gamma`` has the Dirichlet weights of the texts' topics, one row a text.
    """
    log_theta = _digamma(gamma) - _digamma(gamma.sum(axis=1, keepdims=True))
    terms = log_theta[texts] + log_beta[indices]
    top = terms.max(axis=1)
    likely = top + np.log(np.exp(terms - top[:, None]).sum(axis=1))
    bounds = np.bincount(texts, weights=counts * likely, minlength=len(gamma))
    bounds += ((alpha - gamma) * log_theta).sum(axis=1)
    bounds += (_log_gamma(gamma) - _log_gamma(alpha)).sum(axis=1)
    return bounds + math.lgamma(alpha.sum()) - _log_gamma(gamma.sum(axis=1))


@dataclass
class TopicModel:
    """A fitted topic model with its vocabulary and the texts it was fitted on."""
    spark: SparkSession
    model: LDAModel
    vocabulary: list[str]
    features: DataFrame

    def terms(self, top: int = 10) -> DataFrame:
        """The heaviest terms of each topic: topic, rank, term, weight."""
        words = self.spark.createDataFrame(
            list(enumerate(self.vocabulary)), "term_index int, term string")
        return (
            self.model.describeTopics(top)
            .select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("at", "t"))
            .select("topic", (F.col("at") + 1).alias("rank"), F.col("t.termIndices").alias("term_index"),
                    F.col("t.termWeights").alias("weight"))
            .join(words, "term_index").select("topic", "rank", "term", "weight")
            .orderBy("topic", "rank")
        )

    def documents(self) -> DataFrame:
        """Texts with ``topicDistribution`` and ``dominant_topic``."""
        return self.model.transform(self.features).withColumn("dominant_topic", dominant_topic())

    def metrics(self) -> dict[str, float]:
        """Bound on log perplexity and log likelihood of the fitted texts.

        The bound of ``LDAModel.logLikelihood``, from one pass over the texts: the weights of a
        text's topics follow from its distribution, as they sum to its terms and the prior. Each
        text starts from the model's seed, so the values do not depend on the partitions.
        """
        alpha = self.model.estimatedDocConcentration().toArray()
        eta, weights = self.model.getTopicConcentration(), self.model.topicsMatrix().toArray()
        log_beta = _digamma(weights) - _digamma(weights.sum(axis=0))

        def run(batches):
            # A hundred texts at a time: the weights take several numbers for each term and topic.
            for batch in (whole.slice(at, 100) for whole in batches for at in range(0, whole.num_rows, 100)):
                # A vector is a struct in Arrow; that of a text without terms has empty lists.
                indices, counts = [batch.column("features").field(k) for k in ("indices", "values")]
                lengths = indices.value_lengths().to_numpy()
                found = lengths > 0
                texts = np.repeat(np.arange(found.sum()), lengths[found])
                counts = counts.flatten().to_numpy()
                sizes = np.bincount(texts, weights=counts, minlength=found.sum())
                shares = batch.column("shares").flatten().to_numpy().reshape(len(found), -1)[found]
                gamma = shares * (sizes + alpha.sum())[:, None]
                bounds = _text_bounds(indices.flatten().to_numpy(), counts, texts, gamma, alpha, log_beta)
                yield pa.RecordBatch.from_pydict({"bound": bounds, "terms": sizes})

        found = self.model.transform(self.features.select("features")).select(
            "features", vector_to_array("topicDistribution").alias("shares")).mapInArrow(run, "bound double, terms double")
        totals = found.agg(F.coalesce(F.sum("bound"), F.lit(0.0)), F.coalesce(F.sum("terms"), F.lit(0.0)))
        # Batches are also held by the JVM, outside of its heap.
        setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
        rows = int(self.spark.conf.get(setting))
        self.spark.conf.set(setting, min(rows, 500) if rows > 0 else 500)
        try:
            bound, terms = totals.first()
        finally:
            self.spark.conf.set(setting, rows)
        bound += ((eta - weights) * log_beta).sum() + (_log_gamma(weights) - math.lgamma(eta)).sum()
        bound += weights.shape[1] * math.lgamma(eta * len(weights)) - _log_gamma(weights.sum(axis=0)).sum()
        return {"log_perplexity": float(-np.float64(bound) / terms), "log_likelihood": float(bound)}


def fit_topics(spark: SparkSession, texts: DataFrame, text: str = "full_text", topics: int = 10,
               iterations: int = 20, vocabulary: int = 10000, min_documents: float = 2.0,
               strip_punctuation: bool = True, seed: int = 42) -> TopicModel:
    """Term counts and latent Dirichlet allocation.

    ``strip_punctuation`` tokenises the text without punctuation; otherwise the text
    as it is. The vocabulary size bounds what the driver holds.
    """
    source = text
    if strip_punctuation:
        source = "text_clean"
        texts = texts.withColumn(source, F.regexp_replace(text, PUNCTUATION, ""))
    words = RegexTokenizer(inputCol=source, outputCol="words", pattern=WORD_SEPARATORS)
    remover = StopWordsRemover(inputCol="words", outputCol="filtered_words")
    counter = CountVectorizer(inputCol="filtered_words", outputCol="features",
                              vocabSize=vocabulary, minDF=min_documents)
    texts = PipelineModel(stages=[words, remover]).transform(texts).drop("words")
    # The words are read twice, for the vocabulary and for the counts; texts are not kept. Both tables
    # stay on disk, where executors hold none of them between tasks. A task does hold what it writes or
    # reads of them, up to a hundred batches, and a list of words takes over three times the memory of a line.
    kept = texts.select(F.concat_ws(" ", "filtered_words").alias("filtered_words")).persist(StorageLevel.DISK_ONLY)
    listed = kept.select(F.array_remove(F.split("filtered_words", " "), "").alias("filtered_words"))
    prepared = Pipeline(stages=[counter]).fit(listed)
    # Terms of equal count come in no fixed order, on which the start of the topics
    # depends; in alphabetical order the same texts give the same topics.
    terms = sorted(prepared.stages[-1].vocabulary)
    counted = CountVectorizerModel.from_vocabulary(terms, "filtered_words", "features")
    counts = counted.transform(listed).select("features").persist(StorageLevel.DISK_ONLY)
    try:
        model = LDA(k=topics, maxIter=iterations, featuresCol="features", topicConcentration=1 / topics,
                    optimizeDocConcentration=True, seed=seed).fit(counts)
    finally:
        counts.unpersist()
        kept.unpersist()
    return TopicModel(spark, model, terms, counted.transform(texts))
