import random

import cases
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from clickloom.llm import unigram
from clickloom.llm.queries.op7 import VOCABULARY


def tokenizer(vocabulary, by_bytes):
    t = Tokenizer(models.Unigram(list(vocabulary), unk_id=0, byte_fallback=by_bytes))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


def texts(alphabet, n=1500):
    draw = random.Random(1)
    made = ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 30))) for _ in range(n)]
    return ["", " ", "  ", "▁", "a  b", "\n", "<unk>", "<0x0A>", *made, *[r[1] or "" for r in cases.edge_rows()]]


def test_counts_equal_the_tokenizer_on_the_public_vocabulary():
    vocabulary = unigram.read_vocabulary(VOCABULARY)
    counter, slow = unigram.Counter(vocabulary), tokenizer(vocabulary, True)
    for text in texts("ab ▁\n中\U0001F600é<0x4>\t  the ing"):
        assert counter.count(text) == len(slow.encode(text, add_special_tokens=False).ids), text


@pytest.mark.parametrize("seed", range(4))
def test_ties_and_unknowns_in_small_vocabularies(seed):
    draw = random.Random(seed)
    pieces = {"".join(draw.choice("ab▁") for _ in range(draw.randint(1, 4))) for _ in range(12)}
    vocabulary = [("<unk>", 0.0), *((p, float(-draw.randint(1, 3))) for p in sorted(pieces))]
    counter, slow = unigram.Counter(vocabulary), tokenizer(vocabulary, False)
    for text in texts("abc "):
        assert counter.count(text) == len(slow.encode(text, add_special_tokens=False).ids), text


def test_column(spark):
    got = cases.edge_docs(spark).select("text", unigram.token_count("text", VOCABULARY).alias("n")).collect()
    counter = unigram.Counter(unigram.read_vocabulary(VOCABULARY))
    assert all(r.n == counter.count(r.text or "") for r in got) and len(got) == len(cases.edge_rows())
