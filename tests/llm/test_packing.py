import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chatterscope.llm.packing import Piece, WordEncoder, differencing, pack, windows_cut, windows_whole

PATH = public_tokenizers.path("word_bpe_49k.json")

ODD_TEXTS = [
    "", " ", "\n\t ", "it's John's, don't: 'strong' 'SHE'S'", "ÉCOLE straße naïve ÿ ª µ İstanbul Σίσυφος ΟΔΟΣ",
    "á É. ȩ́, Å", "x≠y ≯", "12345 3.14 a1b2", "<|endoftext|> foo<|startoftext|>bar <|x|>", "...!?--''\"\"",
    "no break space\u0085next\x1cunit", "\x00\x01 zero", "日本語 テスト 😀👍🏽", "a" * 3000, "the " * 5000, "End.'s more.\"",
]


def test_encoder_equals_tokenizer():
    import pyarrow as pa

    tokenizer, encoder = Tokenizer.from_file(PATH), WordEncoder(PATH, cache_words=50)
    rng = random.Random(5)
    alphabet = "abcXYZéÉñß.,'!-= \n\t0123😀́"
    texts = [*ODD_TEXTS, *["".join(rng.choices(alphabet, k=rng.randrange(80))) for _ in range(300)]]
    got = encoder.encode(pa.array(texts))
    again = encoder.encode(pa.array(texts[::-1]))[::-1]
    for text, a, b in zip(texts, got, again, strict=True):
        assert a.tolist() == b.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def checked(rows, docs, capacity):
    """Every id in one piece, gapless sequences within the capacity; gives the padding."""
    tokenizer = Tokenizer.from_file(PATH)
    ids = defaultdict(list)
    for doc_id, text in docs:
        ids[doc_id] = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert (zlib.crc32(own), len(ids[r.doc_id])) == (r.ids_crc32, r.doc_tokens)
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for spans, sizes in ((by_doc, {k: len(v) for k, v in ids.items()}), (by_sequence, None)):
        for key, own in spans.items():
            at = 0
            for start, length in sorted(own):
                assert start == at and length > 0
                at += length
            assert at == sizes[key] if sizes else at <= capacity
    assert set(by_doc) == set(ids)
    return len(by_sequence) * capacity - sum(map(len, ids.values()))


def test_pack_odd_texts(make_docs):
    texts = [*enumerate(ODD_TEXTS), (100, None), (101, "word " * 20_000)]
    rows = pack(make_docs(texts, clashing=True).coalesce(1), capacity=256, group_tokens=2000).collect()
    assert 0 <= checked(rows, texts, 256) < 256


def test_pack_empty_table(make_docs):
    assert pack(make_docs([])).collect() == []


def test_pack_repeated_rows_are_packed_one_by_one(make_docs):
    rows = pack(make_docs([(1, "a b"), (1, "a b")]).coalesce(1)).collect()
    assert sum(r.length for r in rows) == 6 and len({r.sequence_id for r in rows}) == 1


def test_with_ids(make_docs):
    row = pack(make_docs(["hello world"]), with_ids=True).first()
    assert row.ids == [*Tokenizer.from_file(PATH).encode("hello world").ids, 1]


@pytest.mark.parametrize("sizes, parts", [([8, 7, 6, 5, 4], 2), ([5, 5, 5, 5], 4), ([1], 3), ([], 2), ([9, 1, 1, 1], 3), ([3] * 10, 1)])
def test_differencing_deals_every_item(sizes, parts):
    dealt = differencing(sizes, parts)
    assert len(dealt) == parts and sorted(i for w in dealt for i in w) == list(range(len(sizes)))


def test_differencing_is_near_equal():
    sums = [sum([8, 7, 6, 5, 4][i] for i in w) for w in differencing([8, 7, 6, 5, 4], 2)]
    assert sorted(sums) == [14, 16]  # the known result of the two-way case
    rng = random.Random(1)
    sizes = [rng.randrange(1, 200) for _ in range(400)]
    sums = [sum(sizes[i] for i in w) for w in differencing(sizes, 20)]
    assert max(sums) - min(sums) <= 2


def test_window_count_rises_until_whole_items_fit():
    dealt = windows_whole([60] * 5, 100)
    assert len(dealt) == 5 and all(len(w) == 1 for w in dealt)
    with pytest.raises(ValueError):
        windows_whole([101], 100)


def test_cut_windows_keep_the_capacity():
    pieces = [Piece(k, n, 0, np.arange(n, dtype=np.uint32)) for k, n in enumerate([90, 90, 90, 30])]
    assert [sum(len(p.ids) for p in w) for w in windows_cut(pieces, 3, 100)] == [100, 100, 100]
