import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from corpora import awkward, empty, prose
from pyarrow import fs
from tokenizers import Tokenizer

from furrow.llm import token_files as tf
from furrow.session import scratch_path

WORDS, BYTES = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXTS = [
    "Don't, it's 'tis <|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> x",
    "ÉCOLE École école İI ΣΑΣ ﬁ  nb sp \x1cfs \x85nel",
    "a.b,c;d!e?f'g\"h(i)j[k]l{m}n<o>p|q~r`s^t_u=v+w*x&y%z$1#2@3",
    "word,…word …,word ≮ x≮ 1/2 3.14 1e-5 user@example.com http://a.b/c?d=e#f",
    "\t\x0b\x0c\r\n",
    "漢字かな 한국어 हिन्दी 👩‍👩‍👧‍👦🇩🇪 ́start",
    "x" * 5_000,
    "!" * 300,
]


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 11, 15, 16, 17, 24, 31, 32])
def test_bits_go_there_and_back(bits):
    r = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = r.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        data = tf.pack(ids, bits)
        assert len(data) == -(-n // 8) * bits
        # One long number, lowest id first.
        assert int.from_bytes(data, "little") == sum(int(x) << (bits * i) for i, x in enumerate(ids))
        for a, b in ((0, n), (n // 3, n // 2), (n, n)):
            assert tf.unpack(data, bits, a, b).tolist() == ids[a:b].tolist()
    assert tf.bits_for(1 << bits) == bits and tf.bits_for((1 << bits) - 1) == max(bits, 1)


def test_an_id_that_does_not_fit_is_refused():
    with pytest.raises(ValueError, match="does not fit"):
        tf.pack(np.array([8]), 3)


@pytest.mark.parametrize(("path", "by_word"), [(WORDS, True), (BYTES, False)])
def test_encoder_gives_the_ids_of_whole_texts(path, by_word):
    import pyarrow as pa

    r = random.Random(5)
    alphabet = "abAB zéÉß'.,<|>!?-09\t\ń…"
    texts = TEXTS + ["", " "] + ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(3_000)]
    own, plain = tf.Encoder(path), Tokenizer.from_file(path)
    assert own.by_word == by_word
    for part in (texts[:1], texts[1:40], texts[40:], texts[:100]):
        lengths, ids = own.encode(pa.array(part, pa.string()))
        wanted = [plain.encode(t, add_special_tokens=False).ids for t in part]
        assert lengths.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [i for w in wanted for i in w]


@pytest.fixture(scope="module")
def docs(spark):
    return awkward(spark, TEXTS + [prose(i, 3 * i) for i in range(200)])


def brute(docs):
    plain, rows = Tokenizer.from_file(WORDS), []
    for r in docs.collect():
        rows.append((r.doc_id, [*plain.encode(r.text or "", add_special_tokens=False).ids, 1]))
    return rows


@pytest.mark.parametrize("range_ids", [500, 1 << 24])
def test_files_hold_every_document_in_order(spark, docs, range_ids):
    path = scratch_path(spark, "token-test")
    tf.write_documents(docs.repartition(5), path, WORDS, end_id=1, files=3)
    rows = sorted(tf.read(spark, path, range_ids).collect(), key=lambda r: r.start)
    wanted = brute(docs)
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(i), ids) for i, ids in wanted)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert keys == sorted(keys)
    assert [r.start for r in rows] == np.cumsum([0, *[len(r.ids) for r in rows]])[:-1].tolist()
    assert all(r.n_tokens == len(r.ids) for r in rows)
    sums = {(r.start, r.ids_crc32) for r in tf.checksums(tf.read(spark, path, range_ids)).collect()}
    assert sums == {(r.start, zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())) for r in rows}


def test_random_access(spark, docs):
    path = scratch_path(spark, "token-test")
    tf.write_documents(docs, path, WORDS, end_id=1, files=5)
    stream = [i for r in sorted(tf.read(spark, path).collect(), key=lambda r: r.start) for i in r.ids]
    assert len(tf.manifest(path)["files"]) > 1
    r = random.Random(2)
    wanted = [(r.randrange(-5, len(stream) + 5), r.randrange(0, 9_000)) for _ in range(40)] + [(0, len(stream)), (5, 0), (None, 3), (3, None)]
    found = tf.stretches(spark.createDataFrame(wanted, "start long, length long"), path).collect()
    assert len(found) == len(wanted)
    for f in found:
        begin = max(f.start or 0, 0)
        assert f.ids == (None if f.start is None or f.length is None else stream[begin : begin + f.length])


def test_width_index_and_damage(spark, docs):
    path = scratch_path(spark, "token-test")
    tf.write_documents(docs, path, WORDS, end_id=1)
    held = tf.manifest(path)
    assert held["bits"] == 16 and held["vocabulary"] == 49_408
    store, there = tf.file_system(path)
    name = f"{there}/{held['files'][0]['name']}"
    one = tf.PackedFile(store, name)
    assert one.n_ids == held["files"][0]["n_ids"] and one.document(0).tolist()[-1] == 1
    assert int(one.offsets[-1]) <= 8 + (one.n_ids + 8) * 2
    with pytest.raises(IndexError):
        one.ids(0, one.n_ids + 1)
    with store.open_input_stream(name) as f:
        data = bytearray(f.read())
    data[20] ^= 255
    with store.open_output_stream(f"{there}/hurt") as f:
        f.write(bytes(data))
    with pytest.raises(ValueError, match="damaged"):
        tf.PackedFile(store, f"{there}/hurt").ids(0, 10)


def test_what_an_uncommitted_task_leaves_does_not_count(spark, docs):
    path = scratch_path(spark, "token-test")
    tf.write_documents(docs, path, WORDS)
    before = tf.read(spark, path).count()
    store, there = tf.file_system(path)
    first = tf.manifest(path)["files"][0]["name"]
    with store.open_input_stream(f"{there}/{first}") as f, store.open_output_stream(f"{there}/part-000000-other.ids") as g:
        g.write(f.read())
    assert tf.read(spark, path).count() == before == docs.count()


def test_empty_table(spark):
    path = scratch_path(spark, "token-test")
    tf.write_documents(empty(spark), path, WORDS, end_id=1)
    assert tf.read(spark, path).count() == 0 and tf.checksums(tf.read(spark, path)).count() == 0
    store, there = tf.file_system(path)
    with store.open_input_stream(f"{there}/{tf.MANIFEST}") as f:
        assert json.loads(f.read())["files"] == []
    assert store.get_file_info(there).type == fs.FileType.Directory
