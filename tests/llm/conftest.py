import public_tokenizers
import pytest
from tokenizers import Tokenizer

#: Texts that are empty, short, repeated, mixed in white space, long words and scripts.
TEXTS = [
    None, "", " ", "\n\t ", "one", "One two", "a b c d e", "A B C D E", "a b c d e f", "  a  b \n c",
    "tab\tand\x0bother\x0cseparators\r\nhere", "no-break space  wide", "x" * 3000, "über ÀÉ ß straße",
    "中文 字符 かな", "é combining", "don't 'S it's I'LL", "12 345 ½ ²", "<|endoftext|> inside <|startoftext|>",
    "😀 emoji 😀😀", "\x00 zero \x1c fs", "end ", "same words " * 400,
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Every text twice (one pair with one id), a null id, and columns with clashing names."""
    rows = [(n, t, "s", n, 1) for n, t in enumerate(TEXTS)] + [(100 + n, t, None, n, 2) for n, t in enumerate(TEXTS)]
    rows += [(3, TEXTS[22], "t", 0, 3), (None, TEXTS[22], "t", 0, 4), (None, None, None, None, None), (3, TEXTS[22], "t", 0, 3)]
    names = "doc_id long, text string, source string, size int, `_row` int"
    frame = spark.createDataFrame(rows, names)
    return frame.selectExpr("*", "size AS n_tokens", "source AS bucket", "size AS block", "source AS node", "size AS label")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def byte_path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_path():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def encode(byte_path, word_path):
    made = {p: Tokenizer.from_file(p) for p in (byte_path, word_path)}
    return lambda path, text: made[path].encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def embeddings(spark):
    return spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
