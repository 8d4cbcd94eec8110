import pytest

LONG = " ".join(f"word{k % 977} tail{k * k % 5003}" for k in range(30_000))
SENTENCE = ("The quick brown fox went over the hill and came back to the old barn where the farmer kept his tools, "
            "three good horses, a cart with new wheels and the hay of a warm and dry summer that nobody would forget. "
            "Later that day a neighbour came by, asked for some help with the fence and stayed until the evening fell.")
#: NULLs in any column, empty and very long texts, ties, repeated rows.
ROWS = [
    (1, SENTENCE, "en", "a", 3), (2, SENTENCE, "en", "a", 3), (2, SENTENCE, "en", "a", 3), (3, SENTENCE.upper(), "en", "b", 1),
    (4, "", "de", "b", 0), (5, None, None, None, None), (None, SENTENCE + " More.", "en", None, 5), (6, " \t\n ", "fr", "c", 4),
    (7, LONG, "en", "c", 9), (8, "one two", "es", "c", 2), (9, "été à l'école où ça va, ñandú ¿qué?", "fr", "é", 8),
    (10, "### *** $$$ 123 456", None, "d", 7), (None, None, None, None, None), (11, SENTENCE.replace("fox", "dog"), "en", "a", 1),
    (12, "x", "en", "", 1), (13, "line one here\n" * 40, "en", "b", 1), (14, "<|endoftext|> don't <|startoftext|>", "en", "b", 2),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def clash_docs(spark, edge_docs):
    """Extra columns named like the operators' results and inner columns."""
    from pyspark.sql import functions as F
    names = ("id key fp root size start target taken source_size n_words n_hit kept base_failed n_tokens n_bytes score block "
             "component_id fingerprint sid pass_no words items held_out n row __words __n __runs __key __id __size __row __dec_k __dec_key "
             "__dec_id __sim_k __sim_id __sim_key __own __html ___x").split()
    return edge_docs.withColumns({n: F.lit("clash") for n in names})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
