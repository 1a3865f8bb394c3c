import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        *[T.StructField(c, T.StringType()) for c in ("fp", "host", "label", "digest", "uid", "n", "word", "score", "key", "part", "file", "pos", "component_id", "kept", "lines", "x", "k", "__w")],
    ]
)
SENTENCE = "the quick brown fox jumps over the lazy dog near the old river bank while seven grey geese watch from a low wall"
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))


def document_rows():
    texts = [
        (1, SENTENCE), (2, SENTENCE.upper()), (3, SENTENCE + " today"), (4, SENTENCE), (4, SENTENCE),
        (5, None), (6, ""), (7, " \n\t "), (8, "one two"), (9, "one two"), (10, "ÀÉÎ straße ÀÉÎ"), (11, "àéî straße àéî"),
        (12, LONG), (13, LONG + " end"), (None, "no identifier here at all"), (14, "a b c a b c a b c\n\na b c a b c a b c\nx"),
        (15, "tie tie"), (16, "TIE tie"), (17, "emoji 🙂🙂 and \x00 control \x1c sep\x85next nbsp"), (18, "#*$%&|<> !!! ... ,,,"),
    ]
    texts += [(100 + i, f"shared line of this host that many documents hold\nown words {i} " + " ".join(f"w{i}v{j}" for j in range(60))) for i in range(25)]
    return [(i, t, "en" if k % 2 else None, None if k % 7 == 3 else "src", k) + ("clash",) * 18 for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(document_rows(), DOCUMENTS)


@pytest.fixture(scope="session")
def docs_file(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    docs.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
