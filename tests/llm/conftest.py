import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"

# Texts with the awkward cases: none, empty, white space only, several kinds of white space, repeats,
# special tokens, characters beyond ASCII, one very long word and one very long text.
AWKWARD = [
    None, "", " ", "\n", "a", "a ", " a", "a  b", "a \n b", "\ta b\x1c c\x85d", "x" * 30_000, "word " * 20_000,
    "<|endoftext|> and <|endoftext|>", "x<|startoftext|>y <|endoftext|>", "Ἀθῆναι ΣΑΣ İstanbul ß ŉ", "é ́x", "日本語 テキスト 😀 👩‍👩‍👧",
    "don't we'll I'M 12345 3.14 a1b2", "#$%&*|<>" * 30, "one two three four five six seven eight " * 3, "a\nb\na\n\n \nb\n", "\x00\x01 \x7f",
    "tab\tand\x0bvt\x0cff\rcr", "same words same words", "same words same words",
]


@pytest.fixture(scope="session")
def texts():
    return pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist() + AWKWARD


@pytest.fixture(scope="session")
def awkward(spark):
    """A frame of the awkward texts: ids missing, repeated and negative, and columns that clash."""
    ids = [None, None, -5, -5, *range(len(AWKWARD) - 4)]
    rows = [(i, t, "en", "s", 0, True, 1.0, "x", 7) for i, t in zip(ids, AWKWARD)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, part string, start int"
    )


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session", autouse=True)
def settled(spark):
    from tidemark.llm.base import settings

    settings(spark)
