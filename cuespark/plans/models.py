"""Linear token classifiers over chosen feature sets.

The one-hot encoding has a column for each ``name=value`` term, in sorted order;
a large vocabulary stays a table, the solvers' share of it is size-checked.  Linear SVMs (one against the rest,
squared hinge unless told otherwise, liblinear's C = 1 and penalised bias) are
columns of the batched solver in ``batched``, so all classes, folds, grid
points or feature sets are fitted by the same passes over the rows;
multinomial ``LogisticRegression`` is Spark ML's.  Complement naive Bayes has a
closed form and stays a table of term counts: neither its vocabulary nor its
weights come to the driver.  Rows with equal features and label are one weighted
row, which leaves every objective as it is.  Training rows are persisted (memory, spilling to
disk) and released afterwards.  Scoring is row-wise, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructField

from ..operators.lookup import look_up
from ..operators.sentences import feature_pairs, feature_value, split_features
from ..operators.vectors import MAX_VOCAB, combine, embed_context, fit_one_hot
from . import batched as Bt
from .relations import FEATURE_NAMES

KEYS = ("doc_id", "token_id")
LABEL = "negcuelabel"

# ---------------------------------------------------------------------------
# Iteration caps, penalty and tuning grid of the original runs.
# The solvers stop earlier, by their tolerance.
# ---------------------------------------------------------------------------
MAX_ITER = {"svm": 4000, "svm_tuning": 2000, "logreg": 2000, "logreg_vectors": 3000}
C = 1.0
GRID_C = (0.01, 0.1, 1.0)
GRID_LOSS = (Bt.HINGE, Bt.SQUARED)
GRID_TOL = (1e-4, 1e-3, 1e-2, 1e-1)
N_FOLDS = 5


def document_fold(n_folds: int = N_FOLDS, seed: int = 17, doc_id: str = "doc_id"):
    """Fold of a row: a hash of its document id."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(doc_id).cast("string")))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(n_folds)).cast("int")


def split_documents(df: DataFrame, test_folds=(0,), n_folds: int = N_FOLDS, seed: int = 17) -> DataFrame:
    """Assign every row a fold by hashing its document id, and ``split`` =
    'test' for the given folds, else 'train'.  Both parts are kept."""
    return (df.withColumn("fold", document_fold(n_folds, seed))
              .withColumn("split", F.when(F.col("fold").isin(list(test_folds)), F.lit("test")).otherwise(F.lit("train"))))


def _classifier(kind: str, max_iter: int | None, reg: float, tol: float, parallelism: int):
    if kind == "logreg":
        return LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", predictionCol="yhat", family="multinomial",
                                  maxIter=max_iter or MAX_ITER["logreg"], regParam=reg, tol=tol, standardization=False)
    if kind == "nb":
        return NaiveBayes(featuresCol="x", labelCol="y", weightCol="w", predictionCol="yhat", modelType="complement")
    raise ValueError(f"unknown model kind {kind!r}")


def c_to_reg(c: float, n_rows: float) -> float:
    """liblinear's C to Spark's regParam (objective scaled by 1/n)."""
    return 1.0 / (c * max(n_rows, 1))


@dataclass
class TokenModel:
    """A fitted token classifier: encoder, label list and classifier model."""
    kind: str
    names: list
    labels: list
    encoder: object
    model: object
    dense_names: list | None = None
    emb: DataFrame | None = None
    dim: int = 0

    def vectors(self, df: DataFrame) -> DataFrame:
        """M7 (scoring side): the feature vector ``x`` of every row."""
        if self.dense_names is None:
            x = df.withColumn("feats", feature_pairs(self.names))
            x = self.encoder.transform(x, self.names)
            return x.withColumn("x", F.col("onehot").alias("x", metadata={})).drop("feats", "onehot")
        return embedding_vectors(df, self.names, self.emb, self.dim, self.encoder)

    def predict(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        """M8: input rows plus the predicted label (row-wise transform)."""
        if isinstance(self.model, Bt.Scorer):
            return self._scored(df, out)
        x = self.model.transform(self.vectors(df))
        lab = F.element_at(F.array(*[F.lit(v) for v in self.labels]), F.col("yhat").cast("int") + 1)
        drop = [c for c in ("x", "yhat", "rawPrediction", "probability") if c in x.columns]
        return x.withColumn(out, lab).drop(*drop)

    def _scored(self, df: DataFrame, out: str) -> DataFrame:
        x, dense = df, None
        if self.dense_names is not None:
            x, dense = embed_context(x, self.emb, self.names, self.dim, out="dense"), F.col("dense").cast("array<double>")
        names = self.names if self.dense_names is None else split_features(self.names, "train")[1]
        yhat = self.model.yhat(df.sparkSession, F.col("_ids"), dense)
        lab = F.element_at(F.array(*[F.lit(v) for v in self.labels]), yhat + 1)
        return _with_ids(x, self.encoder, names, "_ids").withColumn(out, lab).drop("_ids", "dense")


# A feature with at most so many values is looked up without a shuffle.
SMALL_DOMAIN = 20_000


@dataclass
class NaiveBayesModel:
    """Complement naive Bayes as tables.  ``counts``: a row for each term with
    its feature (``name``), ``value`` and the labelled rows of each class that
    hold it (``n0``, ``n1``..); ``totals``: per feature its terms and the sums
    of these columns.  A class scores minus the log share that each of a row's
    terms has among the terms of the other classes."""
    names: list
    labels: list
    counts: DataFrame
    totals: dict
    kind: str = "nb"

    def weights(self) -> DataFrame:
        """``(name, value, w0, w1..)``: what a term adds to each class's score."""
        k, n_terms = range(len(self.labels)), sum(t[0] for t in self.totals.values())
        per_class = [sum(t[1][i] for t in self.totals.values()) for i in k]
        every = sum((F.col(f"n{i}") for i in k), F.lit(0))
        return self.counts.select("name", "value", *[
            (F.log(F.lit(float(sum(per_class) - per_class[i] + n_terms))) - F.log((every - F.col(f"n{i}") + 1).cast("double"))).alias(f"w{i}") for i in k])

    def predict(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        """M8: input rows plus the label of the highest score (the first of
        equals).  The weights of a feature meet the rows by its value."""
        # in the order of the sorted terms: sums as over the encoded vector
        names = sorted(self.names, key=lambda n: f"{n}=")
        if any(self.totals[n][0] > SMALL_DOMAIN for n in names):
            return self._predicted_by_chunks(df, names, out)
        k, weights = range(len(self.labels)), self.weights()
        x = df.select("*", *[F.lit(0.0).alias(f"_s{i}") for i in k])
        for name in names:
            look = F.broadcast(weights.where(F.col("name") == name).select(F.col("value").alias("_v"), *[f"w{i}" for i in k]))
            x = x.join(look, feature_value(name) == F.col("_v"), "left").select(
                *df.columns, *[(F.col(f"_s{i}") + F.coalesce(F.col(f"w{i}"), F.lit(0.0))).alias(f"_s{i}") for i in k])
        scores = F.array(*[F.col(f"_s{i}") for i in k])
        best = F.array_position(scores, F.array_max(scores)).cast("int")
        return x.select(*df.columns, F.element_at(F.array(*[F.lit(v) for v in self.labels]), best).alias(out))

    def _predicted_by_chunks(self, df: DataFrame, names: list, out: str) -> DataFrame:
        """The same with weights too many to send: ``look_up``."""
        labels, k = list(self.labels), len(self.labels)
        plain = lambda n: isinstance(df.schema[n].dataType, (StringType, IntegralType))
        column = {n: n if plain(n) else f"_k_{n}" for n in names}
        x = df.select("*", *[feature_value(n).alias(c) for n, c in column.items() if c != n])
        number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("name")) - 1
        table = self.weights().select("value", number.alias("grp"), *[f"w{i}" for i in range(k)])
        kind = df.sparkSession.range(0).select(F.array(*[F.lit(v) for v in labels])).schema[0].dataType.elementType

        def best(place, found):
            n = len(next(iter(place.values())))
            scores = np.zeros((n, k))
            if len(found["w0"]):
                weights = np.stack([found[f"w{i}"] for i in range(k)], axis=1)
                for name in names:
                    p = place[column[name]]
                    scores += np.where((p >= 0)[:, None], weights[p], 0.0)
            return {out: pa.array(labels).take(pa.array(scores.argmax(axis=1)))}

        keys = {column[n]: i for i, n in enumerate(names)}
        return look_up(x, keys, table, best, [StructField(out, kind)], keep=df.columns)

    # ---- the dense forms, for vocabularies that the driver can hold ----

    @property
    def model(self) -> NaiveBayesModel:
        return self

    @cached_property
    def _rows(self) -> list:
        if (n := sum(t[0] for t in self.totals.values())) > MAX_VOCAB:
            raise ValueError(f"{n} terms are more than the driver holds")
        return self.weights().withColumn("term", F.concat("name", F.lit("="), "value")).orderBy("term").collect()

    @property
    def encoder(self) -> CountVectorizerModel:
        return CountVectorizerModel.from_vocabulary([r.term for r in self._rows], inputCol="feats", outputCol="onehot", binary=True)

    @property
    def theta(self) -> DenseMatrix:
        k = range(len(self.labels))
        return DenseMatrix(len(k), len(self._rows), [r[f"w{i}"] for i in k for r in self._rows], isTransposed=True)


def train_naive_bayes(df: DataFrame, names=FEATURE_NAMES, label: str = LABEL) -> NaiveBayesModel:
    """M4: the terms of each feature counted per class and written once; only
    a row of sums for each feature comes to the driver.  Terms of rows without
    a label are terms, but count for no class."""
    from ..session import materialize
    names, labels = list(names), _labels(df, label)
    if not labels:
        raise ValueError("no labelled rows")
    of = [F.count(F.when(F.col(label) == v, 1)).alias(f"n{i}") for i, v in enumerate(labels)]
    parts = [df.groupBy(feature_value(n).alias("value")).agg(*of).select(F.lit(n).alias("name"), "*") for n in names]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    counts = materialize(counts, "term-counts")
    sums = counts.groupBy("name").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(labels))])
    totals = {r.name: (r.n, [r[f"n{i}"] for i in range(len(labels))]) for r in sums.collect()}
    return NaiveBayesModel(names, labels, counts, totals)


def _labels(df: DataFrame, label: str) -> list:
    """The classes, sorted; a null label is none."""
    rows = df.select(label).where(F.col(label).isNotNull()).distinct().limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("label column has more than 1000 classes")
    return sorted(r[0] for r in rows)


def _indexed(df: DataFrame, labels: list, label: str) -> DataFrame:
    """Labelled rows with the place of their class as ``y``."""
    idx = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(label)) - 1
    return df.where(F.col(label).isNotNull()).withColumn("y", idx.cast("double"))


def _with_ids(df: DataFrame, encoder, names, out: str = "ids") -> DataFrame:
    """Term numbers of every row: one for each of ``names`` that the encoder
    knows the value of, in the order of the names' terms."""
    if encoder is None:
        return df.withColumn(out, F.array().cast("array<int>"))
    return encoder.numbers(df, names, out)


def _n_terms(encoder) -> int:
    return encoder.size if encoder is not None else 0


def _svm(x: DataFrame, encoder, slots: int, labels, c: float, tol: float, max_iter, loss: str, dim: int = 0):
    """One-vs-rest SVM on rows ``ids, y, w`` (and ``dense``)."""
    with Bt.Problems(x, _n_terms(encoder), slots, dim) as p:
        theta = p.fit([Bt.Column(k, c, loss) for k in range(len(labels))], (tol,), max_iter or MAX_ITER["svm"])[tol]
    return Bt.Scorer(theta, _n_terms(encoder))


def _distinct_rows(df: DataFrame, columns) -> DataFrame:
    """Equal rows of ``columns`` as one row with weight ``w``."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("w"))


def _fit(x: DataFrame, kind: str, max_iter, c: float, tol: float, parallelism: int):
    """Fit on persisted weighted rows ``x, y, w``."""
    x = x.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = x.agg(F.sum("w")).first()[0] or 0
        return _classifier(kind, max_iter, c_to_reg(c, n), tol, parallelism).fit(x)
    finally:
        x.unpersist()


def train(df: DataFrame, names=FEATURE_NAMES, kind: str = "svm", label: str = LABEL, max_iter: int | None = None,
          c: float = C, tol: float = 1e-4, parallelism: int = 3, max_vocab: int = MAX_VOCAB, loss: str = Bt.SQUARED) -> TokenModel:
    """M2 / M3 / M4: fit a one-hot token classifier on ``names``."""
    if kind == "nb":
        return train_naive_bayes(df, names, label)
    names = list(names)
    enc = fit_one_hot(df, names, max_vocab=max_vocab)
    labels = _labels(df, label)
    rows = _distinct_rows(df, [*names, label])
    if kind == "svm":
        x = _indexed(_with_ids(rows, enc, names), labels, label).select("ids", "y", "w")
        return TokenModel(kind, names, labels, enc, _svm(x, enc, len(names), labels, c, tol, max_iter, loss))
    x = enc.transform(rows.select(feature_pairs(names).alias("feats"), F.col(label), "w"), names)
    x = _indexed(x.select(F.col("onehot").alias("x", metadata={}), label, "w"), labels, label).select("x", "y", "w")
    return TokenModel(kind, names, labels, enc, _fit(x, kind, max_iter, c, tol, parallelism))


def train_svm_sets(df: DataFrame, sets, label: str = LABEL, max_iter: int | None = None, c: float = C, tol: float = 1e-4,
                   loss: str = Bt.SQUARED) -> list[TokenModel]:
    """M2 for many feature sets at once: one encoding of all their features,
    whose terms are switched off for the sets that lack them.  The models are
    those of separate fits (a term that is off has weight 0)."""
    names = sorted({n for s in sets for n in s})
    enc = fit_one_hot(df, names, max_vocab=MAX_VOCAB)
    labels = _labels(df, label)
    x = _indexed(_with_ids(_distinct_rows(df, [*names, label]), enc, names), labels, label).select("ids", "y", "w")
    # terms are sorted as text, so a row's numbers come in the order of name=
    slots = sorted(names, key=lambda n: f"{n}=")
    columns = [Bt.Column(k, c, loss, None, tuple(i for i, n in enumerate(slots) if n in s)) for s in sets for k in range(len(labels))]
    with Bt.Problems(x, _n_terms(enc), len(names)) as p:
        theta = p.fit(columns, (tol,), max_iter or MAX_ITER["svm"])[tol]
    k = len(labels)
    return [TokenModel("svm", names, labels, enc, Bt.Scorer(theta[i * k: (i + 1) * k], _n_terms(enc))) for i in range(len(sets))]


def embedding_vectors(df: DataFrame, names, emb: DataFrame, dim: int, encoder=None, variant: str = "train", keep=None):
    """M7: J4 dense vectors + one-hot of the remaining features -> ``x``;
    ``keep``: the columns to return beside it (None: all)."""
    _, one_hot_names = split_features(names, variant)
    onehot = bool(one_hot_names) and encoder is not None
    # encoded first: vectors are not carried through the encoder's lookups
    keep = df.columns if keep is None else list(keep)
    used = list(dict.fromkeys([*keep, "lemma", *(n for n in ("prev", "next") if n in names)]))
    x = encoder.transform(df.withColumn("feats", feature_pairs(one_hot_names)), one_hot_names, keep=used) if onehot else df
    x = embed_context(x, emb, names, dim, out="dense")
    return combine(x, "onehot" if onehot else None, "dense", "x", keep)


def train_embeddings(df: DataFrame, emb: DataFrame, dim: int, names=FEATURE_NAMES, kind: str = "svm",
                     label: str = LABEL, max_iter: int | None = None, c: float = C, tol: float = 1e-4,
                     parallelism: int = 3) -> TokenModel:
    """M5: classifier on dense word vectors plus one-hot features.  Complement
    naive Bayes needs non-negative inputs and is refused for vectors."""
    if kind == "nb":
        raise ValueError("naive Bayes cannot take (possibly negative) word vectors")
    names = list(names)
    _, one_hot_names = split_features(names, "train")
    enc = fit_one_hot(df, one_hot_names, max_vocab=MAX_VOCAB) if one_hot_names else None
    labels = _labels(df, label)
    columns = list(dict.fromkeys([*one_hot_names, "lemma", *(n for n in ("prev", "next") if n in names)]))
    rows = _distinct_rows(df, [*columns, label])
    if kind == "svm":
        x = _with_ids(embed_context(rows, emb, names, dim, out="dense"), enc, one_hot_names)
        x = _indexed(x, labels, label).select("ids", "y", "w", F.col("dense").cast("array<double>").alias("dense"))
        width = dim * (1 + sum(n in names for n in ("prev", "next")))
        model = _svm(x, enc, len(one_hot_names), labels, c, tol, max_iter, Bt.SQUARED, width)
        return TokenModel(kind, names, labels, enc, model, dense_names=["lemma", "prev", "next"], emb=emb, dim=dim)
    x = _indexed(embedding_vectors(rows, names, emb, dim, enc), labels, label).select("x", "y", "w")
    model = _fit(x, kind, max_iter or MAX_ITER["logreg_vectors" if kind == "logreg" else kind], c, tol, parallelism)
    return TokenModel(kind, names, labels, enc, model, dense_names=["lemma", "prev", "next"], emb=emb, dim=dim)


def _macro_f1(conf_rows) -> float:
    """Macro F1 over the classes of truth or prediction from a tiny list of
    (true, predicted, count) rows."""
    classes = {r[0] for r in conf_rows} | {r[1] for r in conf_rows}
    scores = []
    for c in classes:
        tp = sum(n for t, p, n in conf_rows if t == c and p == c)
        pred = sum(n for t, p, n in conf_rows if p == c)
        true = sum(n for t, p, n in conf_rows if t == c)
        pr = tp / pred if pred else 0.0
        rc = tp / true if true else 0.0
        scores.append(2 * pr * rc / (pr + rc) if pr + rc else 0.0)
    return sum(scores) / len(scores) if scores else 0.0


def tune_svm_grid(df: DataFrame, names=FEATURE_NAMES, label: str = LABEL, cs=GRID_C, losses=GRID_LOSS, tols=GRID_TOL, n_folds: int = N_FOLDS,
                  max_iter: int = MAX_ITER["svm_tuning"], seed: int = 29):
    """Grid over loss x C x tol scored by macro F1 with document-grouped
    folds (hashed with their own seed, independent of ``split_documents``).

    Equal rows of a fold are one weighted row, encoded once.  Every (class,
    fold, C, loss) is a column of one batched fit, and the tolerances are
    points of that fit, so the grid costs the passes of its slowest column.
    Scores come from the confusion counts (at most #classes^2 rows a unit).
    Returns the best model refitted on all rows (the first of equals) and
    ``(loss, c, tol, folds, macro F1)`` of every grid point.
    """
    names = list(names)
    enc = fit_one_hot(df, names, max_vocab=MAX_VOCAB)
    labels = _labels(df, label)
    rows = _distinct_rows(df.withColumn("fold", document_fold(n_folds, seed)), ["fold", *names, label])
    x = _indexed(_with_ids(rows, enc, names), labels, label).select("ids", "y", "w", "fold")
    with Bt.Problems(x, _n_terms(enc), len(names)) as p:
        folds = [r[0] for r in rows.select("fold").distinct().orderBy("fold").collect()]
        units = [(k, [Bt.Column(y, c, loss, k) for y in range(len(labels))], (loss, c)) for loss in losses for c in cs for k in folds]
        fits = p.fit([col for _, cols, _ in units for col in cols], tols, max_iter)
        scores = {}
        for t in tols:
            cells = [[] for _ in units]
            for u, true, pred, w in p.confusion([u[:2] for u in units], fits[t], len(labels)):
                cells[u].append((true, pred, w))
            for (_, _, point), conf in zip(units, cells):
                scores.setdefault((*point, t), []).append(_macro_f1(conf))
        results = [(loss, float(c), float(t), len(folds), sum(scores[loss, c, t]) / len(folds)) for loss in losses for c in cs for t in tols]
        loss, c, t, *_ = max(results, key=lambda r: r[4])
        theta = p.fit([Bt.Column(y, c, loss) for y in range(len(labels))], (t,), max_iter)[t]
    return TokenModel("svm", names, labels, enc, Bt.Scorer(theta, _n_terms(enc))), results


def tune_svm(df: DataFrame, names=FEATURE_NAMES, label: str = LABEL, cs=GRID_C, tols=GRID_TOL, n_folds: int = N_FOLDS,
             max_iter: int = MAX_ITER["svm_tuning"], seed: int = 29, loss: str = Bt.HINGE):
    """The grid for one loss: best model and ``(c, tol, folds, macro F1)``."""
    best, results = tune_svm_grid(df, names, label, cs, (loss,), tols, n_folds, max_iter, seed)
    return best, [r[1:] for r in results]
