import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import categories, cleaning, clusters, labels, sentiment, text_model
from starloom.operators.profile import class_sizes
from starloom.plans.training import main as train_main
from starloom.sources.reviews import save_csv


@pytest.fixture(scope="module")
def texts(spark):
    data = [
        (0, "Great, works well. GREAT!", "positive"),
        (1, "Broken and useless", "negative"),
        (2, "It is a lamp", "neutral"),
        (3, None, "neutral"),
        (4, "bad good", "neutral"),
        (5, "greatest badge", "neutral"),
    ]
    return spark.createDataFrame(data, "review_id long, `reviews.text` string, expected string")


def test_word_lists(texts):
    scored = sentiment.baseline_sentiment(texts)
    assert scored.where("predicted_sentiment <> expected OR predicted_sentiment IS NULL").isEmpty()
    own = sentiment.baseline_sentiment(texts, negative=["lamp"], positive=["it", "is"])
    assert own.where("review_id = 2").first()["predicted_sentiment"] == "positive"


def test_word_lists_read_the_whole_text_unless_told(spark):
    df = spark.createDataFrame([("x " * 600 + "great",)], "`reviews.text` string")
    assert sentiment.baseline_sentiment(df).first()["predicted_sentiment"] == "positive"
    cut = sentiment.baseline_sentiment(df, max_length=512)
    assert cut.first()["predicted_sentiment"] == "neutral"


def test_model_hook_runs_in_batches_beside_its_row(texts):
    def load():
        def predict(batch):
            return np.array(["LABEL_2" if "lamp" in text else "LABEL_0" for text in batch])

        return predict

    scored = sentiment.baseline_sentiment(texts, load_model=load, max_length=3)
    found = {r["review_id"]: r["predicted_sentiment"] for r in scored.collect()}
    # The lamp is the fourth token.
    assert set(found.values()) == {"negative"}
    longer = sentiment.baseline_sentiment(texts, load_model=load, max_length=4)
    found = {r["review_id"]: r["predicted_sentiment"] for r in longer.collect()}
    assert found[2] == "positive" and found[1] == "negative"


@pytest.fixture(scope="module")
def training(spark):
    words = F.array(F.lit("awful broken"), F.lit("plain usual"), F.lit("great lovely"))
    names = F.array(F.lit("negative"), F.lit("neutral"), F.lit("positive"))
    place = (F.col("id") % 3 + 1).cast("int")
    return spark.range(300).select(
        F.col("id").alias("review_id"),
        F.concat_ws(" ", F.element_at(words, place), (F.col("id") % 11).cast("string")).alias(
            "reviews.text"
        ),
        F.element_at(names, place).alias("rating_sentiment"),
    )


def test_training_saving_and_predicting(training, tmp_path):
    path = str(tmp_path / "model")
    model, report = text_model.train_sentiment(training, path, num_features=1 << 12)
    scores = {r["label"]: r for r in report.collect()}
    assert scores["accuracy"]["f1_score"] > 0.95
    assert {"negative", "neutral", "positive", "macro avg", "weighted avg"} <= set(scores)
    assert 60 < scores["accuracy"]["support"] < 120
    loaded = text_model.load_model(path)
    fresh = training.limit(30).withColumns({"text": F.lit(None), "prediction": F.lit("own")})
    predicted = text_model.predict_sentiment(loaded, fresh)
    assert predicted.columns == [*fresh.columns, "predicted_sentiment"]
    same = text_model.predict_sentiment(model, fresh)
    assert sorted(predicted.collect()) == sorted(same.collect())


def test_training_from_the_command_line(training, tmp_path, capsys):
    data, out = str(tmp_path / "balanced.csv"), str(tmp_path / "model")
    save_csv(training.drop("review_id"), data)
    train_main(["--data", data, "--out", out, "--max-iter", "5"])
    shown = [line.strip("|").split("|") for line in capsys.readouterr().out.splitlines()]
    scores = {row[0].strip(): row[3] for row in shown if len(row) == 5}
    assert {"negative", "neutral", "positive", "accuracy"} <= set(scores)
    assert float(scores["accuracy"]) > 0.9
    assert text_model.load_model(out).stages


def test_clusters(spark):
    rng = np.random.default_rng(0)
    data = [(i, (rng.normal(0, 0.1, 4) + 5 * (i % 2)).tolist()) for i in range(100)]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    models, scores = clusters.cluster_sweep(vectors, [2, 3])
    by_k = {r["k"]: r["silhouette"] for r in scores.collect()}
    assert by_k[2] > 0.9 and by_k[2] > by_k[3]
    assigned = clusters.assign_clusters(models[2], vectors)
    assert assigned.columns == ["vec_id", "embedding", "cluster"]
    assert sorted(r["count"] for r in class_sizes(assigned, "cluster").collect()) == [50, 50]


def test_name_embeddings(spark):
    def load():
        return lambda names: np.array([[float(len(n)), 1.0] for n in names], dtype=np.float32)

    df = spark.createDataFrame([("ab",), ("abcd",)], "name string")
    found = [r[0] for r in df.select(clusters.embed_names("name", load)).collect()]
    assert found == [[2.0, 1.0], [4.0, 1.0]]


def test_row_local_operators_take_a_stream(spark, tmp_path):
    """The same chain on a table and on a stream of its files gives the same rows."""
    data = [(5.0, "great", "Dog Crates", "LABEL_2"), (1.0, None, "Audio", "LABEL_0")]
    schema = "`Reviews.Rating` double, `reviews.text` string, categories string, model_label string"
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "in"))
    table = spark.read.parquet(str(tmp_path / "in"))
    mapping = categories.mapping_table(spark, {"Audio": "Electronics"})

    def chain(df):
        df = labels.assign_sentiment_labels(cleaning.clean_columns(df))
        df = labels.encode_labels(labels.attach_model_labels(df, "model_label"))
        df = sentiment.baseline_sentiment(df.drop("predicted_sentiment"))
        return cleaning.plain_names(categories.join_mapping(df, mapping))

    stream = chain(spark.readStream.schema(table.schema).parquet(str(tmp_path / "in")))
    query = (
        stream.writeStream.format("memory")
        .queryName("chained")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    assert sorted(map(str, spark.table("chained").collect())) == sorted(
        map(str, chain(table).collect())
    )
