"""Feature engineering, training, evaluation and reporting (L1-L19) on Spark ML.

Evaluation is relational: confusion cells are a ``groupBy(label, prediction)`` (k^2 rows
for k classes) and every report is derived from those cells, so nothing row-level ever
reaches the driver.  Only model-sized objects (feature importances, per-iteration losses,
cross-validation metrics) are read on the driver, and they are bounded by model
parameters, not by data.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, IDF, ElementwiseProduct, RegexTokenizer, StandardScaler, VectorAssembler, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioflow.functions.columns import char_len
from biblioflow.operators import trees as G
from biblioflow.operators.trees import best_round

TEXT_COLS = ("title", "abstract")
SCALAR_COLS = ("ref_count", "abstract_len", "title_len")


# L1 ------------------------------------------------------------------------------------
def text_stages(cols: Sequence[str] = TEXT_COLS, num_features: int = 1 << 12, method: str = "tfidf",
                vector_size: int = 64, seed: int = 42) -> tuple[list, list, list[str]]:
    """Per text column a fixed-width vector (NULL text -> ''): hashed TF-IDF (default) or
    Word2Vec, whose document vector is the mean of its word vectors (the analogue of a
    mean-pooled encoder).  Returns the stages that need no fit (a row's tokens and hashed
    counts), the ones that are fitted, and the names of the vectors."""
    plain, fitted, outs = [], [], []
    for c in cols:
        plain.append(RegexTokenizer(inputCol=f"{c}_text", outputCol=f"{c}_tokens", pattern=r"\W+", minTokenLength=1))
        if method == "word2vec":
            fitted.append(Word2Vec(inputCol=f"{c}_tokens", outputCol=f"{c}_vec", vectorSize=vector_size, minCount=1, seed=seed))
        else:
            plain.append(HashingTF(inputCol=f"{c}_tokens", outputCol=f"{c}_tf", numFeatures=num_features))
            fitted.append(IDF(inputCol=f"{c}_tf", outputCol=f"{c}_vec"))
        outs.append(f"{c}_vec")
    return plain, fitted, outs


def with_text_inputs(df: DataFrame, cols: Sequence[str] = TEXT_COLS) -> DataFrame:
    return df.select("*", *[F.coalesce(F.col(c), F.lit("")).alias(f"{c}_text") for c in cols])


def pooled(tokens, dim: int):
    """Mean over a text's token vectors (tokens x dim); a text without tokens gives zeros."""
    import numpy as np

    t = np.asarray(tokens, dtype="float64").reshape(-1, dim)
    return t.mean(axis=0) if len(t) else np.zeros(dim)


def encoder_udf(factory: Callable[[], Callable], dim: int, batch_size: int = 256):
    """Hook for a user text encoder.  ``factory()`` is called once per Python worker task and
    returns ``encode(list[str])``: per text its token vectors (tokens x dim, padding left out)
    or, if the encoder pools itself, one vector.  Token vectors are averaged over the token
    axis.  Texts of an Arrow batch are encoded in batches of similar length, at most
    ``batch_size`` each, so that padding costs little; NULL counts as ''.  Gives an
    ``array<float>`` of ``dim``."""
    import numpy as np

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _enc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = factory()
        for s in batches:
            texts = s.fillna("").tolist()
            out = np.zeros((len(texts), dim), dtype="float32")
            order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
            for at in range(0, len(order), batch_size):
                rows = order[at:at + batch_size]
                for i, tokens in zip(rows, encode([texts[i] for i in rows]), strict=True):
                    out[i] = pooled(tokens, dim)
            yield pd.Series(list(out), dtype=object)

    return _enc


# L2 ------------------------------------------------------------------------------------
def scalar_features(df: DataFrame) -> DataFrame:
    """``ref_count``, abstract length, title length (code points; NULL stays NULL)."""
    return df.select("*", char_len(F.col("abstract")).alias("abstract_len"), char_len(F.col("title")).alias("title_len"))


# C16 (ML form) -------------------------------------------------------------------------
def one_hot_stages(column: str, out: str | None = None) -> list:
    """Dummy vector of a categorical column as Spark ML stages (the relational form is
    ``reshape.one_hot``).  The value list is learned by a distributed count, never
    collected by the caller; unseen and NULL values map to the all-zero vector."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    idx = StringIndexer(inputCol=column, outputCol=f"{column}_idx", handleInvalid="keep", stringOrderType="alphabetAsc")
    enc = OneHotEncoder(inputCol=f"{column}_idx", outputCol=out or f"{column}_vec", dropLast=True, handleInvalid="error")
    return [idx, enc]


# L3 / L4 -------------------------------------------------------------------------------
@dataclass(frozen=True)
class PopulationScaling:
    """Per-slot mean and inverse population deviation of a vector column (0 where a slot is
    constant).  Sparse vectors are multiplied only (``stage``), which keeps them sparse; what
    centring would take off is the same ``offset`` for every row, so a linear model's
    intercept absorbs it and a tree's thresholds move with it.  ``centred`` takes it off where
    the centred values themselves are wanted."""

    mean: DenseVector
    inverse: DenseVector

    @property
    def offset(self) -> list[float]:
        return [float(m * i) for m, i in zip(self.mean, self.inverse)]

    def stage(self, column: str, out: str) -> ElementwiseProduct:
        return ElementwiseProduct(inputCol=column, outputCol=out, scalingVec=self.inverse)

    def centred(self, scaled: str) -> Column:
        """Population z-scores as an array, from the scaled column."""
        return F.zip_with(vector_to_array(F.col(scaled)), F.lit(self.offset), lambda x, o: x - o)


def population_scaling(rows: DataFrame, column: str) -> PopulationScaling:
    """One aggregate over ``rows`` (``Summarizer`` has the sample variance)."""
    stats = rows.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(column)).alias("s")).select("s.*").first()
    n = stats["count"]
    sd = [math.sqrt(max(v, 0.0) * (n - 1) / n) if n > 1 else 0.0 for v in stats["variance"].toArray()]
    return PopulationScaling(DenseVector(stats["mean"].toArray()), DenseVector([1 / d if d > 0 else 0.0 for d in sd]))


def fit_scaling(vectors: DataFrame, text_vecs: Sequence[str], scalars: Sequence[str] = SCALAR_COLS) -> list:
    """Fitted stages that assemble text vectors and scalars, each group scaled to population
    deviation 1; scalars are centred too, text vectors by their offset (``PopulationScaling``)."""
    joined = VectorAssembler(inputCols=list(text_vecs), outputCol="text_raw", handleInvalid="keep")
    plain = VectorAssembler(inputCols=list(scalars), outputCol="scalar_raw", handleInvalid="keep")
    both = plain.transform(joined.transform(vectors)).select("text_raw", "scalar_raw")
    text = population_scaling(both, "text_raw").stage("text_raw", "text_scaled")
    sample = StandardScaler(inputCol="scalar_raw", outputCol="scalar_sample", withMean=True, withStd=True).fit(both)
    n = both.count()
    wider = ElementwiseProduct(inputCol="scalar_sample", outputCol="scalar_scaled",
                               scalingVec=DenseVector([math.sqrt(n / (n - 1)) if n > 1 else 1.0] * len(scalars)))
    return [joined, text, plain, sample, wider, VectorAssembler(inputCols=["text_scaled", "scalar_scaled"], outputCol="features")]


def standardise(df: DataFrame, cols: Sequence[str], fitted_on: DataFrame) -> DataFrame:
    """Population z-scores ``<col>_z`` (mean and ``stddev_pop`` of ``fitted_on``, one
    aggregate; 0 where the column is constant there, NULL where the value is)."""
    stats = fitted_on.agg(F.struct(*[f(c).alias(f"{c}_{k}") for c in cols for k, f in (("m", F.avg), ("s", F.stddev_pop))])).scalar()
    df = df.withColumn("_stats", stats)
    z = {f"{c}_z": F.coalesce(F.try_divide(F.col(c) - F.col(f"_stats.{c}_m"), F.col(f"_stats.{c}_s")), F.when(F.col(c).isNotNull(), 0.0)) for c in cols}
    return df.withColumns(z).drop("_stats")


def feature_names(df: DataFrame, text_cols: Sequence[str] = TEXT_COLS, num_features: int = 1 << 12,
                  scalars: Sequence[str] = SCALAR_COLS) -> DataFrame:
    """Generated names in vector order: ``title_i``, ``abstract_i``, then the scalars."""
    spark = df.sparkSession
    frames = [spark.range(num_features).select(F.lit(i).alias("grp"), F.col("id").alias("i"),
                                               F.concat(F.lit(f"{c}_"), F.col("id").cast("string")).alias("feature"))
              for i, c in enumerate(text_cols)]
    base = len(text_cols)
    scal = spark.createDataFrame([(base, j, s) for j, s in enumerate(scalars)], "grp int, i long, feature string")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    out = out.unionByName(scal.select("grp", "i", "feature"))
    return out.select((F.col("grp").cast("long") * F.lit(num_features) + F.col("i")).alias("index"), "feature")


# L5 / L6 -------------------------------------------------------------------------------
def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (k * n_c); n and k are scalar subqueries."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    n = counts.select(F.sum("n_c")).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    return counts.select(label, "n_c", (n / (k * F.col("n_c"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str = "label", weights: DataFrame | None = None) -> DataFrame:
    """Attach the class weight to every row: the weights are one map (an entry per class) from
    a scalar subquery, so the rows aren't shuffled by the label."""
    w = class_weights(df, label) if weights is None else weights
    found = w.where(F.col(label).isNotNull()).agg(F.map_from_entries(F.collect_list(F.struct(label, "weight")))).scalar()
    return df.withColumn("_weights", found).withColumn("weight", F.try_element_at("_weights", F.col(label))).drop("_weights")


#: Ranges of a given order in the stratified split.
QUANTILES = 128


# L7 ------------------------------------------------------------------------------------
def class_ranks(df: DataFrame, label: str, order: Column | None, seed: int, id_col: str, buckets: int = 1024) -> DataFrame:
    """``df`` with ``_rank`` (from 1) of each row within its class in ``order`` (default a
    seeded hash of ``id_col``) and ``_n_c``, the class's rows.

    Exact rank without one task per class: the order value is cut into ranges; rank = rows of
    the class in lower ranges (a k x ranges aggregate, cumulated over that small frame) +
    row_number within (class, range).  The hash spans its range evenly, so ``buckets`` equal
    ranges need no pass over the data; a given ``order`` is cut at QUANTILES approximate
    quantiles, so clustered or outlying values still fill the ranges evenly.  (Any bounds
    give the same ranks.)"""
    o = order if order is not None else F.xxhash64(F.col(id_col), F.lit(seed))
    v = df.withColumn("_o", o.cast("double"))
    if order is None:
        b = F.least(F.floor((F.col("_o") + 2.0 ** 63) / 2.0 ** 64 * buckets), F.lit(buckets - 1)).cast("int")
    else:
        cuts = v.select(F.percentile_approx("_o", [i / QUANTILES for i in range(1, QUANTILES)], 10_000)).scalar()
        v = v.withColumn("_cuts", cuts)
        b = F.when(F.col("_o").isNull(), -1).otherwise(F.size(F.filter("_cuts", lambda x: x < F.col("_o"))))
    v = v.withColumn("_b", b)
    per = v.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    # rows of the class in lower ranges, and the class total, over the small (class, range) frame
    before = F.sum("_cnt").over(Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    info = per.select(label, "_b", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_cnt").over(Window.partitionBy(label)).alias("_n_c"))
    w = Window.partitionBy(label, "_b").orderBy("_o", *([F.col(id_col)] if id_col in df.columns else []))
    ranked = v.join(info, [label, "_b"], "left").withColumn("_rank", F.col("_before") + F.row_number().over(w))
    return ranked.drop("_o", "_b", "_cuts", "_before")


def stratified_split(df: DataFrame, label: str = "label", order: Column | None = None, test_fraction: float = 0.2,
                     seed: int = 42, id_col: str = "doc_id", buckets: int = 1024) -> DataFrame:
    """Exact stratified split: per class, the first round(f * n_c) rows in ``order`` (default
    a seeded hash of ``id_col``, see ``class_ranks``) are test rows."""
    ranked = class_ranks(df, label, order, seed, id_col, buckets)
    n_test = F.round(F.col("_n_c") * test_fraction).cast("long")
    return ranked.withColumn("is_test", F.col("_rank") <= n_test).drop("_rank", "_n_c")


def stratified_folds(df: DataFrame, folds: int = 5, label: str = "label", order: Column | None = None, seed: int = 42,
                     id_col: str = "doc_id") -> DataFrame:
    """``df`` with ``fold`` (0 to folds - 1): the rank within the class modulo ``folds``, so a
    fold holds each class within one row of n_c / folds."""
    ranked = class_ranks(df, label, order, seed, id_col)
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank", "_n_c")


def three_way_split(df: DataFrame, label: str = "label", seed: int = 42, id_col: str = "doc_id",
                    materialize: bool = True) -> DataFrame:
    """train / validation / test: test = exact stratified 20 %, validation = exact 20 % of
    the rest (fit only on train; early stopping on validation; report on test).  The first
    split is stored so the second split reads it, not its lineage."""
    s1 = stratified_split(df, label, None, 0.2, seed, id_col)
    if materialize:
        s1 = stored(s1, "split")
    rest = s1.where(~F.col("is_test")).drop("is_test")
    s2 = stratified_split(rest, label, None, 0.2, seed + 1, id_col).withColumnRenamed("is_test", "is_validation")
    test = s1.where(F.col("is_test")).drop("is_test").withColumn("is_validation", F.lit(False))
    return s2.withColumn("split", F.when(F.col("is_validation"), "validation").otherwise("train")).unionByName(
        test.withColumn("split", F.lit("test")))


# L8 / L9 / L11 -------------------------------------------------------------------------
def random_forest(weight: str | None = "weight", trees: int = 100, max_depth: int = 30, seed: int = 42) -> RandomForestClassifier:
    """Fully grown trees as far as Spark grows them (depth 30), two rows at least in a leaf.
    (Spark has no separate least size of a node to split; its leaf bound implies 4 rows.)
    Rows keep the node they are in, and a pass takes more nodes than by default: the trees
    are the same, but a deep forest isn't walked from its roots in every pass."""
    rf = RandomForestClassifier(labelCol="label_d", featuresCol="features", numTrees=trees, maxDepth=max_depth,
                                minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True, maxMemoryInMB=512)
    return rf.setWeightCol(weight) if weight else rf


def gradient_boosting(weight: str | None = "weight", iters: int = 50, depth: int = 6, step: float = 0.1, seed: int = 42) -> GBTClassifier:
    kw = dict(labelCol="label_d", featuresCol="features", maxIter=iters, maxDepth=depth, stepSize=step,
              subsamplingRate=0.8, seed=seed)
    if weight:
        kw["weightCol"] = weight
    return GBTClassifier(**kw)


def logistic(weight: str | None = "weight") -> LogisticRegression:
    lr = LogisticRegression(labelCol="label_d", featuresCol="features", maxIter=50, regParam=0.01)
    return lr.setWeightCol(weight) if weight else lr


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back (columns stay
    prunable, and a lost executor costs no recomputation)."""
    from biblioflow.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def training_frame(spark: SparkSession, base: DataFrame, label: str = "label", id_col: str = "doc_id") -> DataFrame:
    """Split, NULL ref counts dropped (D7), scalar features, double label, class weights
    computed on the training rows only.  The split runs over (id, label) alone; texts are
    joined to it once, and the result is stored as Parquet for the estimators' passes."""
    rows = base.na.drop(subset=["ref_count"])
    split = stored(three_way_split(stored(rows.select(id_col, label), "labelled"), label, id_col=id_col), "split")
    weights = class_weights(split.where(F.col("split") == "train"), label)
    split = with_class_weights(split, label, weights).withColumn("label_d", F.col(label).cast("double"))
    return stored(with_text_inputs(scalar_features(rows)).join(split.drop(label), id_col), "training")


#: Rows of a partition that trees are fitted on: no more than the first, and no fewer than the
#: second where the cluster has cores for them (each partition sends the statistics of all
#: nodes of a pass, so more partitions than that cost more than they save).
MOST_ROWS, LEAST_ROWS = 50_000, 500


def training_parts(rows: DataFrame) -> int:
    """Partitions to fit ``rows`` in; stored frames may have one, however long a fit takes."""
    n = rows.count()
    return max(1, -(-n // MOST_ROWS), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_ROWS)))


def hashed_texts(rows: DataFrame, num_features: int = 1 << 12, method: str = "tfidf") -> DataFrame:
    """``rows`` with the text columns' tokens or hashed counts instead of the texts, stored, so
    that fits and folds don't tokenise again."""
    plain, fitted, _ = text_stages(num_features=num_features, method=method)
    out = PipelineModel(stages=plain).transform(rows)
    keep = {s.getInputCol() for s in fitted}
    return stored(out.select(*[c for c in out.columns if c in keep or not c.endswith(("_text", "_tokens", "_tf")) and c not in TEXT_COLS]), "hashed")


def fit_features(hashed: DataFrame, num_features: int = 1 << 12, method: str = "tfidf") -> list:
    """Fitted stages from ``hashed_texts`` to ``features``."""
    _, fitted, vecs = text_stages(num_features=num_features, method=method)
    models = [s.fit(hashed) for s in fitted]
    return models + fit_scaling(PipelineModel(stages=models).transform(hashed), vecs)


def fit_model(train: DataFrame, classifier, num_features: int = 1 << 12, method: str = "tfidf") -> PipelineModel:
    """Feature stages and classifier fitted on all rows given (training and validation rows
    for a final fit); texts are tokenised once and the features stored for the classifier's
    passes.  Returns one PipelineModel, from texts to predictions, so serving applies exactly
    the fitted scaling."""
    plain, _, _ = text_stages(num_features=num_features, method=method)
    hashed = hashed_texts(train, num_features, method)
    fitted = fit_features(hashed, num_features, method)
    rows = PipelineModel(stages=fitted).transform(hashed).select(*_used(classifier))
    rows = stored(rows.repartition(training_parts(hashed)), "features")
    return persisted(train.sparkSession, PipelineModel(stages=plain + fitted + [fit_classifier(rows, classifier)]))


def fit_classifier(rows: DataFrame, classifier):
    """``classifier`` fitted on ``rows``; a forest by ``grown_forest``, where that can."""
    grown = grown_forest(rows, classifier) if isinstance(classifier, RandomForestClassifier) else None
    return grown or classifier.fit(rows)


#: What a forest must have for ``grown_forest``.
_PLAIN_FOREST = {"impurity": "gini", "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "maxBins": G.MAX_BINS}


def grown_forest(rows: DataFrame, forest: RandomForestClassifier) -> RandomForestClassificationModel | None:
    """The forest that ``forest`` describes, its trees grown side by side from sparse rows, one
    task a core, each over all rows: a bootstrap of its own, and a draw of features a node.
    None if the rows are none or too many for a task (``trees.MOST_ENTRIES``), or if it has
    settings that only Spark's own fit knows."""
    spark, get = rows.sparkSession, lambda p: forest.getOrDefault(p)
    if any(get(k) != v for k, v in _PLAIN_FOREST.items()) or get("featureSubsetStrategy") != "sqrt":
        return None
    weight = F.col(get("weightCol")).cast("double") if forest.isDefined("weightCol") and get("weightCol") else F.lit(1.0)
    plain = rows.select(F.col(forest.getLabelCol()).cast("double").alias("label"), weight.alias("weight"), F.lit(False).alias("held"),
                        F.col(forest.getFeaturesCol()).alias("features"))
    found = G.packed(plain, training_parts(rows), None, G.MOST_ENTRIES["forest"])
    if found is None:
        return None
    blocks, layout = found
    tasks = max(1, min(spark.sparkContext.defaultParallelism, get("numTrees")))
    classes = max(2, int(plain.agg(F.max("label")).first()[0]) + 1)  # one number
    width = len(layout.zero)
    grow = G.forest(layout, get("numTrees"), tasks, classes, get("maxDepth"), get("minInstancesPerNode"), math.ceil(math.sqrt(width)),
                    get("bootstrap") and get("numTrees") > 1, get("subsamplingRate"), get("seed"))
    every = stored(blocks, "blocks").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    nodes = stored(every.repartitionById(tasks, F.col("k")).mapInArrow(grow, G.NODES), "nodes")
    path = _model_path(spark, "forest")
    given = {p.name: v for p, v in forest._paramMap.items()}
    G.save_ensemble(nodes, path, "classification.RandomForestClassificationModel", "classification.DecisionTreeClassificationModel",
                    [1.0] * get("numTrees"), given, width, numClasses=classes)
    return RandomForestClassificationModel.load(path)


def _model_path(spark: SparkSession, name: str) -> str:
    from biblioflow.session import scratch_path

    return scratch_path(spark, name)


def _used(classifier) -> list[str]:
    """The columns that a fit reads."""
    weight = classifier.getOrDefault("weightCol") if classifier.isDefined("weightCol") else None
    return [c for c in (classifier.getLabelCol(), classifier.getFeaturesCol(), weight) if c]


def ensemble(trees: Sequence, weights: Sequence[float]) -> GBTClassificationModel:
    """A boosted classifier of given regression trees and weights."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    tree_array = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weight_array = sc._gateway.new_array(sc._jvm.double, len(trees))
    for i, (t, w) in enumerate(zip(trees, weights)):
        tree_array[i], weight_array[i] = t._java_obj, float(w)
    uid = f"GBTClassifier_{uuid.uuid4().hex[:12]}"
    return GBTClassificationModel(sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(uid, tree_array, weight_array))


#: Rounds between two stored margins.
CHUNK_ROUNDS = 10


def boost(rows: DataFrame, iters: int = 500, patience: int = 100, step: float = 0.05, depth: int = 6, min_leaf: int = 10,
          seed: int = 42, id_col: str = "doc_id") -> tuple[GBTClassificationModel, list[float]]:
    """Boosted trees for the log-loss, with early stopping: each round fits a regression tree to
    the gradient at the margins so far, ``step`` of it is added, and the loss of the
    validation rows is taken.  No more rounds are fitted than the best one and ``patience``
    after it, nor than ``iters``.  Returns the model up to its best round and the losses of
    all rounds.

    One task grows all trees from sparse rows (``trees.boosted``), as far as it can hold them
    (``trees.MOST_ENTRIES``): a round is then no Spark job.  Of more rows each round is a fit
    of Spark's (``boost_by_jobs``).

    ``rows`` has ``<id_col>, is_validation, label_d, weight, features``.  Rows are dealt by a
    hash of the id into partitions by their number, and sorted, so the same rows give the
    same trees whatever their layout."""
    parts = training_parts(rows)
    plain = rows.select(id_col, F.col("label_d").alias("label"), F.col("weight").cast("double"), F.col("is_validation").alias("held"), "features")
    found = G.packed(plain, parts, id_col, G.MOST_ENTRIES["boosted"])
    if found is None:
        return boost_by_jobs(rows, parts, iters, patience, step, depth, min_leaf, seed, id_col)
    blocks, layout = found
    grow = G.boosted(layout, iters, patience, step, depth, min_leaf)
    nodes = stored(stored(blocks, "blocks").coalesce(1).mapInArrow(grow, G.NODES), "rounds")
    losses = [r["prediction"] for r in nodes.where("treeID = -1").select("id", "prediction").orderBy("id").collect()]  # one number a round
    path = _model_path(rows.sparkSession, "boosted")
    G.save_ensemble(nodes, path, "classification.GBTClassificationModel", "regression.DecisionTreeRegressionModel",
                    [step] * best_round(losses, patience), {}, len(layout.zero))
    return GBTClassificationModel.load(path), losses


def boost_by_jobs(rows: DataFrame, parts: int, iters: int, patience: int, step: float, depth: int, min_leaf: int, seed: int,
                  id_col: str) -> tuple[GBTClassificationModel, list[float]]:
    """``boost`` by Spark's regression trees.  Margins are stored with the rows every
    CHUNK_ROUNDS rounds, from where the next rounds go on; nothing is fitted twice."""
    sign = 2 * F.col("label_d") - 1
    state = stored(rows.withColumn("margin", F.lit(0.0)).repartition(parts, id_col).sortWithinPartitions(id_col), "margins")
    trees, losses, best = [], [], 0
    while len(trees) < iters and (not losses or len(losses) < best + patience):
        more = min(CHUNK_ROUNDS, iters - len(trees), (best or 1) + patience - len(trees))
        margins = []
        for k in range(more):
            gradient = 4 * sign / (1 + F.exp(2 * sign * F.col("margin")))
            fitting = state.where(~F.col("is_validation")).withColumn("gradient", gradient)
            tree = DecisionTreeRegressor(labelCol="gradient", featuresCol="features", weightCol="weight", maxDepth=depth,
                                         minInstancesPerNode=min_leaf, seed=seed, predictionCol=f"_tree{k}").fit(fitting)
            trees.append(tree)
            state = tree.transform(state).withColumn("margin", F.col("margin") + F.lit(step) * F.col(f"_tree{k}")).withColumn(f"_margin{k}", F.col("margin"))
            margins.append(f"_margin{k}")
        held = state.where("is_validation").agg(*[F.avg(2 * F.log1p(F.exp(-2 * sign * F.col(m)))).alias(m) for m in margins]).first()
        losses += [float("nan") if v is None else float(v) for v in held]
        best = best_round(losses, patience)
        state = stored(state.select(id_col, "is_validation", "label_d", "weight", "features", "margin"), "margins")
    return ensemble(trees[:best], [step] * best), losses


def fit_boosted(train: DataFrame, num_features: int = 1 << 12, iters: int = 500, patience: int = 100, id_col: str = "doc_id",
                **options) -> tuple[PipelineModel, list[float]]:
    """``boost`` over text and scalar features, which are fitted on the training rows only.
    Returns the whole pipeline, from texts to predictions, and the losses."""
    plain, _, _ = text_stages(num_features=num_features)
    hashed = hashed_texts(train, num_features)
    fitted = fit_features(hashed.where(~F.col("is_validation")), num_features)
    rows = PipelineModel(stages=fitted).transform(hashed).select(id_col, "is_validation", "label_d", "weight", "features")
    model, losses = boost(stored(rows, "boosting"), iters, patience, id_col=id_col, **options)
    return persisted(train.sparkSession, PipelineModel(stages=plain + fitted + [model])), losses


def persisted(spark: SparkSession, model: PipelineModel, path: str | None = None) -> PipelineModel:
    """Save to the shared folder and load back.  The loaded model is identical but carries
    no training summary (which holds a session reference that cannot be serialised into
    tasks once the session has registered observations)."""
    from biblioflow.session import scratch_path

    target = path or scratch_path(spark, "model")
    model.write().overwrite().save(target)
    return PipelineModel.load(target)


#: Fits that run at once: most passes of a tree fit are shorter than what the driver needs
#: between them, and leave cores free.
FITS_AT_ONCE = 5


def side_by_side(spark: SparkSession, fit: Callable, items) -> list:
    """``fit`` of each item, in their order, on a few threads as Spark's own CrossValidator does."""
    from multiprocessing.pool import ThreadPool

    from pyspark.util import inheritable_thread_target

    with ThreadPool(FITS_AT_ONCE) as pool:
        return pool.map(inheritable_thread_target(spark)(fit), list(items), chunksize=1)


# L10 -----------------------------------------------------------------------------------
def cross_validated_f1(train: DataFrame, classifier, folds: int = 5, num_features: int = 1 << 12, seed: int = 42,
                       label: str = "label", id_col: str = "doc_id") -> DataFrame:
    """k-fold positive-class F1 as (mean, sd, mean - 2sd, mean + 2sd), over stratified folds.
    Features are fitted on each fold's training rows; texts are tokenised once.  A fold's
    model is saved and loaded back before it scores (``persisted``), and its F1 comes from
    its confusion counts (0 where nothing is positive).  Folds are fitted side by side."""
    dealt = stratified_folds(hashed_texts(train, num_features), folds, label, seed=seed, id_col=id_col)
    dealt = stored(dealt, "folds")

    def fold_f1(k: int) -> float:
        rest = dealt.where(F.col("fold") != k)
        fitted = fit_features(rest, num_features)
        rows = PipelineModel(stages=fitted).transform(rest).select(*_used(classifier))
        rows = stored(rows.repartition(training_parts(rest)), "fold")
        model = persisted(train.sparkSession, PipelineModel(stages=fitted + [fit_classifier(rows, classifier)]))
        hit = model.transform(dealt.where(F.col("fold") == k)).agg(
            F.count_if((F.col("prediction") == 1) & (F.col("label_d") == 1)).alias("tp"),
            F.count_if((F.col("prediction") == 1) | (F.col("label_d") == 1)).alias("any")).first()
        return 2 * hit["tp"] / (hit["any"] + hit["tp"]) if hit["any"] else 0.0

    scores = side_by_side(train.sparkSession, fold_f1, range(folds))
    mean = sum(scores) / folds
    sd = math.sqrt(sum((x - mean) ** 2 for x in scores) / folds)
    return train.sparkSession.createDataFrame([(folds, mean, sd, mean - 2 * sd, mean + 2 * sd)],
                                              "folds int, f1_mean double, f1_sd double, f1_low double, f1_high double")


# L12 -----------------------------------------------------------------------------------
def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("doc_id", "label")) -> DataFrame:
    """Batch scoring: predicted label and class probabilities."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      F.get(p, 0).alias("p0"), F.get(p, 1).alias("p1"))


def leaderboard(train: DataFrame, valid: DataFrame, models: dict, num_features: int = 1 << 12) -> DataFrame:
    """Fit each model family, evaluate on validation rows -> one leaderboard frame.  Features are
    fitted and stored once for all families, which are fitted side by side."""
    f1 = MulticlassClassificationEvaluator(labelCol="label_d", metricName="fMeasureByLabel", metricLabel=1.0)
    acc = MulticlassClassificationEvaluator(labelCol="label_d", metricName="accuracy")
    auc = BinaryClassificationEvaluator(labelCol="label_d", rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    hashed = hashed_texts(train, num_features)
    features = PipelineModel(stages=fit_features(hashed, num_features))
    used = sorted({c for clf in models.values() for c in _used(clf)})
    fitting = stored(features.transform(hashed).select(*used).repartition(training_parts(hashed)), "features")
    held = stored(features.transform(hashed_texts(valid, num_features)).select("label_d", "features"), "held")

    def judged(name: str) -> tuple[str, float, float, float]:
        model = persisted(train.sparkSession, PipelineModel(stages=[fit_classifier(fitting, models[name])]))
        pred = model.transform(held).cache()
        row = (name, float(f1.evaluate(pred)), float(acc.evaluate(pred)), float(auc.evaluate(pred)))
        pred.unpersist()
        return row

    lb = train.sparkSession.createDataFrame(side_by_side(train.sparkSession, judged, models), "model string, f1 double, accuracy double, auc double")
    return lb.orderBy(F.desc("f1"), "model")


# L13-L15 / L19 -------------------------------------------------------------------------
def confusion_cells(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                    materialize: bool = False) -> DataFrame:
    """(label, prediction, n): one partial-aggregated pass over the predictions.  With
    ``materialize`` the k^2 cells are checkpointed, so reports that read them many times
    (joins, scalar subqueries) never re-score or re-scan the predictions."""
    cells = pred.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))
    if materialize:
        from biblioflow.session import cut_lineage

        cells = cut_lineage(cells)
    return cells


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """Per-class precision / recall / F1 / support, accuracy, macro and weighted averages;
    0/0 -> 0.  Derived from the k^2 confusion cells only (computed once)."""
    cells = confusion_cells(pred, label, prediction, materialize=True)
    classes = cells.select(F.col("label").alias("c")).union(cells.select(F.col("prediction").alias("c"))).distinct()
    tp = cells.where(F.col("label") == F.col("prediction")).select(F.col("label").alias("c"), F.col("n").alias("tp"))
    sup = cells.groupBy(F.col("label").alias("c")).agg(F.sum("n").alias("support"))
    pcount = cells.groupBy(F.col("prediction").alias("c")).agg(F.sum("n").alias("pred_n"))
    per = (classes.join(tp, "c", "left").join(sup, "c", "left").join(pcount, "c", "left")
           .fillna(0, ["tp", "support", "pred_n"]))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred_n")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    per = per.select("c", p.alias("precision"), r.alias("recall"), "support")
    per = per.withColumn("f1_score", F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0)).otherwise(
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))))
    n = cells.select(F.sum("n")).scalar()
    correct = cells.where(F.col("label") == F.col("prediction")).select(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    rows = per.select(F.col("c").cast("string").alias("class"), "precision", "recall", "f1_score", F.col("support").cast("long").alias("support"))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                    F.avg("f1_score").alias("f1_score"), F.sum("support").cast("long").alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                       (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("f1_score"),
                       F.sum("support").cast("long").alias("support"))
    accuracy = per.agg(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                       F.lit(None).cast("double").alias("recall"), (correct / n).cast("double").alias("f1_score"),
                       F.sum("support").cast("long").alias("support"))
    out = rows.unionByName(macro).unionByName(weighted).unionByName(accuracy)
    return out.select("class", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1_score")], "support")


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction", classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Dense matrix, one row per actual class, one column per predicted class, zeros present."""
    cells = confusion_cells(pred, label, prediction)
    wide = cells.groupBy("label").pivot("prediction", list(classes)).agg(F.sum("n"))
    actual = pred.sparkSession.createDataFrame([(int(c),) for c in classes], "label int")
    j = actual.join(wide, "label", "left")
    return j.select("label", *[F.coalesce(F.col(str(c)), F.lit(0)).cast("long").alias(f"pred_{c}") for c in classes])


def confusion_percentages(pred: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 4) -> DataFrame:
    cells = confusion_cells(pred, label, prediction, materialize=True)
    total = cells.select(F.sum("n")).scalar()
    return cells.select("label", "prediction", "n", F.round(F.col("n") * 100.0 / total, digits).alias("pct"))


def metric_table(report: DataFrame, positive: str = "1", digits: int = 4) -> DataFrame:
    """class x metric x percent value for the two classes, plus each class's support share."""
    from biblioflow.functions.terms import POSITIVE_TEXT

    per = report.where(~F.col("class").isin("accuracy", "macro avg", "weighted avg"))
    total = per.select(F.sum("support")).scalar()
    name = F.when(F.col("class") == positive, F.lit(POSITIVE_TEXT)).otherwise(F.lit("Not " + POSITIVE_TEXT))
    long = per.select(name.alias("class_name"), F.expr(
        "stack(3, 'Precision', precision, 'Recall', recall, 'F1-score', f1_score) AS (metric, value)"))
    long = long.select("class_name", "metric", F.round(F.col("value") * 100.0, digits).alias("value"))
    share = per.select(name.alias("class_name"), F.lit("Support share").alias("metric"),
                       F.round(F.col("support") * 100.0 / total, digits).alias("value"))
    return long.unionByName(share)


# L16 / L17 / L18 -----------------------------------------------------------------------
def feature_importance(spark: SparkSession, model, names: DataFrame, k: int = 25) -> DataFrame:
    """Importances (model-sized vector) of all named features, those that no tree uses with
    score 0; top-k by score, ties by name."""
    imp = model.featureImportances
    rows = [(int(i), float(v)) for i, v in zip(imp.indices, imp.values)]
    df = spark.createDataFrame(rows, "index long, score double")
    scored = names.join(df, "index", "left").select("feature", F.coalesce("score", F.lit(0.0)).alias("score"))
    return scored.orderBy(F.desc("score"), "feature").limit(k)


def learning_curve(spark: SparkSession, losses: Sequence[float]) -> DataFrame:
    """Loss on held-out rows after each boosting round, one row per fitted round."""
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(losses)], "round int, loss double")


def training_report(report: DataFrame, confusion: DataFrame, importance: DataFrame, curve: DataFrame | None) -> DataFrame:
    """One-row report: each part collected into an array column (all parts are small:
    classes, features top-k, boosting rounds)."""
    parts = [
        report.agg(F.collect_list(F.struct(*report.columns)).alias("classification_report")),
        confusion.agg(F.collect_list(F.struct(*confusion.columns)).alias("confusion_matrix")),
        importance.agg(F.collect_list(F.struct(*importance.columns)).alias("feature_importance")),
    ]
    if curve is not None:
        parts.append(curve.agg(F.collect_list(F.struct(*curve.columns)).alias("learning_curves")))
    out = parts[0]
    for p in parts[1:]:
        out = out.select("*", *[p.select(c).scalar().alias(c) for c in p.columns])
    return out
