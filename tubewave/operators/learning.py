"""Rules around the classifiers, their training tables and their training with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Target limits of the flag model and codes of unseen categories.
OVER_LIMIT, UNDER_LIMIT = 0.038, -0.030
UNSEEN_CODES = {"channel": 38, "outage_number": 9}
NOT_AVAILABLE = "N/A"


def differentiation_features(flaws: DataFrame, length_buffer: float) -> DataFrame:
    length = F.col("length") - length_buffer
    return flaws.withColumns({"diff_length": length, "lw_ratio": length / F.col("width")})


def category_note(categories: Column) -> Column:
    names = F.array_distinct(categories)
    text = F.concat(F.lit("Warning: Differentiation between "), F.array_join(names, " and "), F.lit(" is inconclusive."))
    return F.when(F.size(names) > 1, text).otherwise(NOT_AVAILABLE)


def differentiate(flaws: DataFrame, debris_limit: float, cc_limit: float) -> DataFrame:
    """Possible categories and note from the two class probabilities ``p_cc`` and ``p_debris``."""
    kind = F.col("flaw_type")
    doubtful_cc = (kind == "CC") & (F.col("p_debris") >= debris_limit)
    doubtful_debris = (kind == "Debris") & (F.col("p_cc") >= cc_limit)
    categories = (
        F.when(doubtful_cc, F.array(F.lit("CC"), F.lit("Debris"))).when(doubtful_debris, F.array(F.lit("Debris"), F.lit("CC"))).otherwise(F.array(kind))
    )
    note = F.when(doubtful_cc | doubtful_debris, category_note(F.array(F.lit("CC"), F.lit("Debris"))))
    return flaws.withColumn("possible_category", categories).withColumn("note1", note)


def flag_cases(df: DataFrame, probability: str, threshold: float, depth: str = "depth") -> DataFrame:
    """Flag uncertain and missing depths; a flagged depth text gets a suffix and a note."""
    flagged = F.col(depth).isNull() | (F.col(probability) >= threshold)
    text = F.when(flagged, F.concat(F.coalesce(F.col(depth).cast("string"), F.lit("nan")), F.lit(" (2)"))).otherwise(F.col(depth).cast("string"))
    return df.withColumns({"flagged": flagged, "depth_out": text, "note2": F.when(flagged, "Depth may be inaccurate").otherwise(NOT_AVAILABLE)})


def encode(df: DataFrame, column: str, codes: DataFrame, unseen: int) -> DataFrame:
    """Codes of a category by a table (``value``, ``code``); a value the table does not know gets ``unseen``."""
    known = codes.select(F.col("value").alias(column), F.col("code").alias(f"{column}_code"))
    return df.join(known, column, "left").withColumn(f"{column}_code", F.coalesce(f"{column}_code", F.lit(unseen)))


def sorted_codes(df: DataFrame, column: str) -> DataFrame:
    """Codes 0, 1, … of the categories in sorted order, a missing one as 'missing'. Meant for few categories."""
    from pyspark.sql import Window

    values = df.select(F.coalesce(column, F.lit("missing")).alias("value")).distinct()
    return values.withColumn("code", (F.row_number().over(Window.orderBy("value")) - 1).cast("int"))


def training_features(matched: DataFrame, stats: list[str] = (), keep_zero: bool = False) -> DataFrame:
    """Matched reported flaws with metrics and box statistics as flat columns; the target is the absolute difference.

    A difference of exactly zero is left out unless ``keep_zero``: it comes from a text, not a measurement.
    """
    metrics = [c for c in ("width_diff", "length_diff", "position_x_diff", "position_y_diff", "depth_diff") if c in matched.columns]
    rows = matched.where("is_predicted AND depth_diff IS NOT NULL")
    if not keep_zero:
        rows = rows.where("depth_diff <> 0")
    other = [c for c in matched.columns if c not in metrics and c not in stats]
    return rows.select(
        *other, *[F.col(c).alias(f"metrics_{c}") for c in metrics if c != "depth_diff"], *[F.col(c).alias(f"bbox_{c}") for c in stats],
        F.abs("depth_diff").alias("depth_diff"),
    )


def training_set(df: DataFrame, target: str = "depth_diff", over: float = OVER_LIMIT, under: float = UNDER_LIMIT) -> DataFrame:
    """Normal-beam use and difference, and the flag target; rows without a target are left out."""
    nb1, nb2 = F.col("depth_nb1"), F.col("depth_nb2")
    delta = F.when(nb1.isNotNull() & nb2.isNotNull(), nb1 - nb2).when(nb1.isNotNull(), nb1).when(nb2.isNotNull(), -nb2)
    t = F.col(target)
    return df.where(t.isNotNull()).withColumns(
        {"nb_used": (nb1.isNotNull() | nb2.isNotNull()).cast("int"), "nb_delta": delta, "flagged": ((t > over) | (t < under)).cast("int")}
    )


def train_flag_model(training: DataFrame, numeric: list[str], categorical: list[str], trees: int = 100, depth: int = 8, seed: int = 42) -> PipelineModel:
    """Median imputation with missing indicators, sorted category codes and a random forest."""
    prepared = with_indicators(training, numeric, categorical)
    stages = [
        Imputer(inputCols=numeric, outputCols=[f"{c}_filled" for c in numeric], strategy="median"),
        *[StringIndexer(inputCol=c, outputCol=f"{c}_code", stringOrderType="alphabetAsc", handleInvalid="keep") for c in categorical],
        VectorAssembler(
            inputCols=[*[f"{c}_filled" for c in numeric], *[f"{c}_missing" for c in numeric], *[f"{c}_code" for c in categorical]], outputCol="features"
        ),
        RandomForestClassifier(labelCol="flagged", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, maxBins=256),
    ]
    return Pipeline(stages=stages).fit(prepared)


def with_indicators(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    flags = {f"{c}_missing": F.col(c).isNull().cast("double") for c in numeric}
    return df.withColumns(flags | {c: F.coalesce(c, F.lit("missing")) for c in categorical})


def flag_probability(model: PipelineModel, df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    scored = model.transform(with_indicators(df, numeric, categorical))
    return scored.withColumn("probability", vector_to_array("probability").getItem(1)).select(*df.columns, "probability")


@dataclass(frozen=True)
class StoredModel:
    """A fitted pipeline (imputation, category codes, forest) with all that is needed to apply it elsewhere."""

    pipeline: PipelineModel
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    #: Names of the classes in the order of the probabilities.
    classes: tuple[str, ...]
    thresholds: dict[str, float] = field(default_factory=dict)

    def save(self, spark: SparkSession, folder: str) -> None:
        """Two tables below ``folder``: the pipeline, and one row of columns, classes and thresholds. What was there is replaced."""
        self.pipeline.write().overwrite().save(f"{folder}/pipeline")
        row = (list(self.numeric), list(self.categorical), list(self.classes), self.thresholds)
        kinds = "numeric array<string>, categorical array<string>, classes array<string>, thresholds map<string, double>"
        spark.createDataFrame([row], kinds).coalesce(1).write.mode("overwrite").parquet(f"{folder}/settings")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> StoredModel:
        own = spark.read.parquet(f"{folder}/settings").first()
        return StoredModel(PipelineModel.load(f"{folder}/pipeline"), tuple(own.numeric), tuple(own.categorical), tuple(own.classes), dict(own.thresholds))

    def apply(self, df: DataFrame, prefix: str = "p_") -> DataFrame:
        """All rows with one probability column a class, ``p_<class in lower case>``; missing numbers are imputed, unseen categories have a code."""
        scored = self.pipeline.transform(with_indicators(df, list(self.numeric), list(self.categorical)))
        values = vector_to_array("probability")
        return scored.select(*df.columns, *[values.getItem(k).alias(f"{prefix}{name.lower()}") for k, name in enumerate(self.classes)])


def train_classes(
    training: DataFrame, label: str, classes: list[str], numeric: list[str], categorical: list[str], thresholds: dict[str, float] | None = None, trees: int = 100, depth: int = 8
) -> StoredModel:
    """A forest that tells the given classes apart; rows of other classes are not learned from."""
    code = F.array_position(F.array(*map(F.lit, classes)), F.col(label)) - 1
    known = training.where(F.col(label).isin(*classes)).withColumn("flagged", code.cast("int"))
    return StoredModel(train_flag_model(known, numeric, categorical, trees, depth), tuple(numeric), tuple(categorical), tuple(classes), thresholds or {})


#: What tells crevice flaws from debris.
SHAPE_FEATURES = ["axial_start", "rotary_start", "diff_length", "width", "lw_ratio"]


def differentiate_by(model: StoredModel, flaws: DataFrame, length_buffer: float) -> DataFrame:
    """Categories and note of each flaw by a stored model of the classes CC and Debris and its thresholds of both names."""
    told = model.apply(differentiation_features(flaws, length_buffer))
    return differentiate(told, model.thresholds["Debris"], model.thresholds["CC"])
