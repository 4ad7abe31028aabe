"""Token files: no text, no id and no learning is left out."""

import struct
from inspect import signature

import numpy as np
import pytest

from gridstats.llm import token_coder
from gridstats.llm.token_coder import BLOCK, _Model, pack, unpack
from gridstats.llm.token_ids import _Encoder, read_token_files, write_token_files
from gridstats.session import scratch_path


def test_every_text_goes_whole_to_the_tokenizer(spark):
    pytest.importorskip("tokenizers")
    vocabulary = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    encoder = _Encoder(vocabulary, by_piece=False)
    plain, given = encoder.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return plain.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counting()
    texts = ["", "the same words, the same words", "the same words", "Zoë's 12\n"] * 50
    coded = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert encoder(texts) == coded == encoder(texts)
    assert given == texts * 2
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    read = []
    for by_piece in (False, True):
        path = scratch_path(spark, "token-files")
        write_token_files(docs, path, vocabulary, end_id=2, by_piece=by_piece)
        read.append(sorted((r[0], r[1], bytes(r[3])) for r in read_token_files(spark, path).collect()))
    assert read[0] == read[1] and [r[2][:-4] for r in read[0]] == coded
    assert signature(write_token_files).parameters["by_piece"].default is False


def test_header_counts_all_ids_of_an_image():
    at = np.arange((1 << 21) + 5000)  # a block shares its ids with every third one
    ids = (at // BLOCK % 3 * 10 + at % 10).astype(np.int64)
    model, places = _Model.of(ids, 30)
    assert (model.one & 3).tolist() == [3] * 30
    assert np.array_equal(model.ids[places], ids)


def test_blocks_learn_what_the_header_does_not_tell(monkeypatch):
    monkeypatch.setattr(token_coder, "_TOGETHER", 7)
    rng = np.random.default_rng(11)
    ids = np.concatenate([np.resize(rng.permutation(64), BLOCK) for _ in range(40)] + [np.arange(64)])
    image = pack([1], [len(ids)], ids, 64)
    assert np.array_equal(unpack(image)[2], ids)
    assert 8 * len(image) < 2.5 * len(ids)  # 6 bits, if every block follows the image's counts
