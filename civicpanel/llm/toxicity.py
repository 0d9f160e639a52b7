"""Toxicity by a classifier chain of linear models.

The categories are predicted one after the other. The model of a category sees which words a
text has and the probabilities of the categories before it. In training these probabilities
are out of fold: each comes from a model that did not see the row, as it will be for new
texts. A model is a logistic regression with an L1 penalty over the words that a chi-square
test finds most telling, so that a category rests on few words and not on the length of a text.

Training uses at most about ``sample`` labelled documents, picked by a hash of their id. Of
copies and near copies, told by the smallest hash of four words in a row, it takes one, so
that a copied text with a wrong label does not teach its words. Vocabulary and coefficients
are bounded by ``vocabulary`` and ``telling``. Scoring runs over all rows and whole texts, as
Spark ML expressions without a shuffle.

NULL and empty texts have no words and get the probability of a text without any. A row teaches
the categories that it has a label for; a category without any label has the probability 0,
and so have all if no term is in ``LEAST_TEXTS`` texts.
Labels of one id are taken together: it is in a category if one of them says so. Labels
without an id are not used. Every row of the documents gets a row, repeated ids too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicpanel.llm.common import text_or_empty, written

SAMPLE = 12_000
VOCABULARY = 1 << 16
#: A term must occur in so many texts of the sample, whatever its size.
LEAST_TEXTS = 6
#: Letters of the beginning of a longer word, which counts as a term of its own.
STEM = 4
#: Terms that a model may use.
TELLING = 200
FOLDS = 3
PENALTY = 2e-4
ITERATIONS = 20
#: Partitions of the sample, which is small, in the many short jobs of training.
PARTITIONS = 4
THRESHOLD = 0.5


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def terms(found: Column) -> Column:
    """Distinct words, and how the longer ones begin: a stem shows in words not met in training."""
    distinct = F.array_distinct(found)
    begins = F.transform(F.filter(distinct, lambda w: F.length(w) > STEM), lambda w: F.concat(F.lit("^"), F.substring(w, 1, STEM)))
    return F.concat(distinct, F.array_distinct(begins))


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], sample: int, seed: int) -> DataFrame:
    """Words of about ``sample`` labelled documents, one of each group of copies, with a 0/1 column per category."""
    known = [c.cast("double").alias(f"_y_{name}") for name, c in categories.items()]
    each = labels.select(F.col("doc_id").cast("long").alias("_doc"), *known).where(F.col("_doc").isNotNull())
    keys = each.groupBy("_doc").agg(*[F.max(f"_y_{name}").alias(f"_y_{name}") for name in categories])
    keys = keys.dropna(how="all", subset=[f"_y_{name}" for name in categories])
    share = min(1.0, sample / max(1, keys.count()))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_doc"), 11) * F.lit(2.0**-53)
    chosen = F.broadcast(keys.where(place < share))  # bounded by ``sample``
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), text_or_empty().alias("_text"))
    found = texts.join(chosen, "_doc").withColumn("_words", words(F.col("_text"))).drop("_text")
    ends = F.sequence(F.lit(1), F.greatest(F.size("_words") - 3, F.lit(1)))
    rows = F.transform(ends, lambda i: F.xxhash64(F.concat_ws(" ", F.slice("_words", i, 4))))
    kept = F.min_by(F.struct(terms(F.col("_words")).alias("_words"), *[f"_y_{n}" for n in categories]), "_doc")
    return found.groupBy(F.array_min(rows).alias("_key")).agg(kept.alias("_row")).select("_key", "_row.*")


@dataclass
class Chain:
    """A vocabulary and one linear model per category, in order."""

    vocabulary: CountVectorizerModel | None
    models: list[tuple[str, PipelineModel | None]]
    categories: list[str]

    def probabilities(self, rows: DataFrame, text: Column) -> DataFrame:
        """``rows`` with ``_p_<category>`` for each category."""
        if self.vocabulary is None:
            return rows.withColumns({f"_p_{c}": F.lit(0.0) for c in self.categories})
        scored = self.vocabulary.transform(rows.withColumn("_words", terms(words(text))))
        for category, model in self.models:
            scored = _scored(model, scored, category)
        return scored.drop("_words", "_counts")


def _scored(model: PipelineModel | None, rows: DataFrame, category: str) -> DataFrame:
    if model is None:
        return rows.withColumn(f"_p_{category}", F.lit(0.0))
    found = model.transform(rows).withColumn(f"_p_{category}", vector_to_array("_probability")[1])
    return found.drop("_telling", "_features", "_probability", "_raw", "_prediction")


def _learner(category: str, earlier: list[str], telling: int, penalty: float) -> Pipeline:
    """Choice of words, then a linear model of them and the earlier probabilities."""
    label = f"_y_{category}"
    chosen = UnivariateFeatureSelector(featuresCol="_counts", outputCol="_telling", labelCol=label, selectionMode="numTopFeatures")
    chosen = chosen.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(telling)
    joined = VectorAssembler(inputCols=["_telling", *earlier], outputCol="_features")
    model = LogisticRegression(
        featuresCol="_features", labelCol=label, probabilityCol="_probability", rawPredictionCol="_raw",
        predictionCol="_prediction", regParam=penalty, elasticNetParam=1.0, maxIter=ITERATIONS,
        standardization=False, family="binomial",
    )
    return Pipeline(stages=[chosen, joined, model])


def _fitted(learner: Pipeline, rows: DataFrame, category: str) -> PipelineModel | None:
    """A model of the rows that have a label of the category; None without any."""
    labelled = rows.where(F.col(f"_y_{category}").isNotNull())
    return learner.fit(labelled) if labelled.limit(1).count() else None


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, Column],
    sample: int = SAMPLE,
    vocabulary: int = VOCABULARY,
    telling: int = TELLING,
    folds: int = FOLDS,
    penalty: float = PENALTY,
    seed: int = 0,
) -> Chain:
    """Fit the chain on documents with labels; ``categories`` are conditions on ``labels``, in order."""
    rows = written(labelled_sample(docs, labels, categories, sample, seed).coalesce(PARTITIONS), "toxicity_sample")
    found = rows.select(F.explode("_words").alias("_word")).groupBy("_word").count()
    if not found.where(F.col("count") >= LEAST_TEXTS).limit(1).count():
        return Chain(None, [], list(categories))
    counted = CountVectorizer(inputCol="_words", outputCol="_counts", vocabSize=vocabulary, minDF=LEAST_TEXTS, binary=True).fit(rows)
    fold = F.pmod(F.xxhash64(F.lit(seed + 1), "_key"), F.lit(folds)).cast("int")
    known = counted.transform(rows.coalesce(PARTITIONS)).drop("_words").withColumn("_fold", fold).cache()
    models, earlier = [], []
    for at, category in enumerate(categories):
        learner = _learner(category, earlier, telling, penalty)
        whole = _fitted(learner, known, category)
        models.append((category, whole))
        if at + 1 == len(categories):
            break
        # What the next model learns from: each fold scored by a model of the other folds.
        held = None
        for k in range(folds):
            model = _fitted(learner, known.where(F.col("_fold") != k), category) or whole
            part = _scored(model, known.where(F.col("_fold") == k), category)
            held = part if held is None else held.unionByName(part)
        old, known = known, written(held, "toxicity_folds").coalesce(PARTITIONS).cache()
        known.count()
        old.unpersist()
        earlier.append(f"_p_{category}")
    known.unpersist()
    return Chain(counted, models, list(categories))


def label_categories() -> dict[str, Column]:
    """The labels table's own categories: low quality first, then toxic."""
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, p_<category> ..., toxic) of every document; ``toxic`` is the verdict of the last category."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("_text"))
    found = chain.probabilities(narrow, F.col("_text"))
    last = F.col(f"_p_{chain.categories[-1]}")
    return found.select("doc_id", *[F.col(f"_p_{c}").alias(f"p_{c}") for c in chain.categories], (last >= THRESHOLD).alias("toxic"))


def without_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of ``docs`` that the chain does not reject, columns as they are."""
    whole = docs.select(F.struct("*").alias("_row"))
    found = chain.probabilities(whole, F.coalesce(F.col("_row.text").cast("string"), F.lit("")))
    return found.where(F.col(f"_p_{chain.categories[-1]}") < THRESHOLD).select("_row.*")
