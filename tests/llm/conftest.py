import pytest

from smogline.session import build_session


@pytest.fixture(scope="session")
def spark():
    yield build_session("*", shuffle_partitions=8)


@pytest.fixture(scope="session")
def odd_documents(spark, tmp_path_factory):
    """A data folder with nulls in every column, empty and very long texts, ties,
    repeated rows and extra columns with names that operators use inside."""
    words = "of the and to in that with this for was"
    prose = " ".join(f"{a}{b}" for a in "stone river window table garden".split() for b in "ab cd ef gh ij kl mn op qr st".split())
    long = " ".join(f"word{i * 7919 % 5003}" for i in range(30_000))
    rows = [
        (1, prose, "en", "a", 1, "x", 0, 1.0),
        (1, prose, "en", "a", 1, "x", 0, 1.0),  # a repeated row
        (2, prose + " end", "en", "a", 1, None, 1, None),
        (3, None, "en", "b", 0, "y", None, 2.0),
        (4, "", None, "b", None, "y", 2, 2.0),
        (5, " \t\n ", "de", None, 3, "z", 3, 3.0),
        (None, words + "\nReleased under the MIT License.\n" + words, "en", "c", 4, "z", 4, 4.0),
        (7, long, "de", "c", 5, "w", 5, 5.0),
        (8, "12345 !!! 67", None, None, 6, "w", 6, 6.0),
        (9, "É" * 3 + " ÀÉ une petite école où l'élève étudie " * 8, "fr", "a", 7, "v", 7, 7.0),
        (10, "a\nb\na\nb\n" * 40, "fr", "a", 7, "v", 7, 7.0),
        (11, "one two three four five six seven eight nine ten eleven twelve", "en", "d", 8, "v", 8, 8.0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard string, size long, score double")
    bench = spark.createDataFrame([(1, "Two three four, five six seven eight nine ten eleven."), (2, None), (3, "!!"), (None, "étudie"), (5, "absent words only")], "item_id long, text string")
    d = str(tmp_path_factory.mktemp("odd"))
    docs.write.parquet(f"{d}/documents.parquet")
    bench.write.parquet(f"{d}/benchmark.parquet")
    pages = [(1, "http://h.example/1", "<html><body><nav>menu</nav><article><h1>T &amp; U</h1><p>One  two<p>three<br>four</article><footer>f</footer>"), (2, None, None), (None, "odd", ""), (3, "http://h.example/2", "<article><p>cut sh<b"), (3, "http://h.example/2", "<article><p>cut sh<b")]
    spark.createDataFrame(pages, "page_id long, url string, html string").withColumnRenamed("page_id", "page_id").write.parquet(f"{d}/pages.parquet")
    vectors = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [0.0, 0.5], None), (2, None, 1), (3, [float("nan"), 1.0], 1), (4, [0.25, -1.0], 1), (5, [], 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    turns = [(0, 0, "user", "hi"), (0, None, None, None), (0, 0, "user", "hi"), (7, 1, "user", ""), (7, 2, "bot", long), (None, 1, "user", "x"), (107, 1, "user", "x"), (-3, 1, None, "y")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    return d


@pytest.fixture(scope="session")
def empty_tables(spark, odd_documents, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "benchmark", "pages", "embeddings", "conversations"):
        spark.read.parquet(f"{odd_documents}/{t}.parquet").where("false").write.parquet(f"{d}/{t}.parquet")
    return d
