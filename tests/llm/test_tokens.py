import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import SMALL
from tokenizers import Tokenizer

from varigrove.llm import bagminhash, common, pieces, queries, token_counts, token_files
from varigrove.llm.common import table

BITS = (
    [" ", " ", "  ", "\n", "\t", "\r\n", "\xa0", "\x1c", "\x85", "　", "​", "\x00", "a", "b", "the", "'s", "'", "don't", "'LL", "42", "٣"]
    + ["é", "ß", "中文", "😀", "é", "Ⅷ", "²", "-", "--", "<|", "<|endoftext|>", "aaaa", "ing"]
)


@pytest.fixture(scope="module")
def library(tokenizer):
    return Tokenizer.from_file(tokenizer)


def strange(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_pieces_are_the_text():
    for text in strange(3000, 1):
        first, *rest = pieces.cut(text)
        assert first + "".join(" " + p for p in rest) == text


def test_ids_and_counts_are_the_library_s(tokenizer, library):
    encoder, counter = token_files.Encoder(tokenizer), token_counts.Counter(tokenizer)
    texts = strange(3000, 2) + ["x" * 3000, "ab " * 2000, "<|endoftext|>" * 50]
    counts = counter.counts(texts)
    for text, n in zip(texts, counts, strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder(text), "<u2").tolist() == ids
        assert n == len(ids)


def test_latin_texts_are_cut_by_the_plain_pattern(tokenizer, library, monkeypatch):
    """Words are not cut at all and are kept once, other Latin texts by a pattern equal to the general one."""
    latin = [chr(n) for n in range(0x250)]
    texts = ["".join(random.Random(n).choices([*latin, *" \t\n's" * 40], k=12)) for n in range(2000)]
    texts += [f"a{c}1 {c}" for c in latin] + ["some words, some-words (some) über den gechö### words"]
    assert [pieces.pretokens(t) for t in texts] == [pieces.PRETOKEN.findall(t) for t in texts]
    monkeypatch.setattr(pieces, "PRETOKEN", None)
    encoder = token_files.Encoder(tokenizer)
    for text in texts:
        assert np.frombuffer(encoder(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
    assert "words" in encoder and " words" not in encoder.tokens


def test_added_tokens_inside_words(tokenizer, tmp_path):
    changed = Tokenizer.from_file(tokenizer)
    changed.add_tokens(["cat"])
    changed.save(str(tmp_path / "cat.json"))
    encoder = token_files.Encoder(str(tmp_path / "cat.json"))
    for text in ("to concatenate cat (cat) cats", "cat", " dogs"):
        assert np.frombuffer(encoder(text), "<u2").tolist() == changed.encode(text, add_special_tokens=False).ids


def test_counts_do_not_depend_on_what_is_known(tokenizer, monkeypatch):
    texts = strange(400, 3)
    want = token_counts.Counter(tokenizer).counts(texts)
    monkeypatch.setattr(pieces, "KEPT_PIECES", 5)
    monkeypatch.setattr(pieces, "KEPT_TOKENS", 5)
    counter, encoder = token_counts.Counter(tokenizer), token_files.Encoder(tokenizer)
    assert [counter.counts([t])[0] for t in texts] == want
    assert [len(encoder(t)) // 2 for t in texts] == want


def test_count_query(spark, library):
    got = {r.doc_id: r for r in queries.op9_token_counts(spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        n = len(library.encode(d.text, add_special_tokens=False).ids)
        r = got[d.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(d.text.encode()), n, n > 1024)


def test_file_query(spark, library):
    got = sorted(queries.op4_token_files(spark, SMALL).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, d in zip(got, sorted(table(spark, SMALL, "documents").collect(), key=lambda d: d.doc_id), strict=True):
        ids = [*library.encode(d.text, add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_frames():
    for data in (b"", b"x", bytes(1000)):
        assert token_files.unframe(token_files.frame(data)) == data
    whole = bytearray(token_files.frame(b"some payload"))
    for n in range(len(whole)):
        whole[n] ^= 1
        with pytest.raises(ValueError):
            token_files.unframe(bytes(whole))
        whole[n] ^= 1
    with pytest.raises(ValueError):
        token_files.unframe(bytes(whole[:-1]))
    doc_id, ids = token_files.unpack(token_files.pack(None, b"\1\0\2\0", 2))
    assert doc_id is None and ids.tolist() == [1, 2]
    assert token_files.unpack(token_files.pack(-5, b"\1\0\0\0", 4))[0] == -5
    assert [token_files.id_width(n) for n in (10, 1 << 16, (1 << 16) + 1)] == [2, 2, 4]


def test_shuffled_reads_and_damage(spark, tokenizer):
    docs = table(spark, SMALL, "documents")
    index = token_files.write(docs, tokenizer)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    some = token_files.read(index.orderBy("offset").where("doc_id % 3 = 1"), queries.token_digest, schema)
    want = {r for r in queries.op4_token_files(spark, SMALL).collect() if r.doc_id % 3 == 1}
    assert set(some.collect()) == want
    first = index.orderBy("start").first()
    store, where = token_files.place(first.file)
    with store.open_input_file(where) as f:
        data = bytearray(f.read())
    data[first.offset + 20] ^= 1
    with store.open_output_stream(where) as f:
        f.write(bytes(data))
    with pytest.raises(Exception, match="checksum"):
        token_files.read(index, queries.token_digest, schema).collect()


def test_odd_rows(odd, none, tokenizer):
    counted = token_counts.token_counts(odd, tokenizer).collect()
    assert sorted((r.n_tokens for r in counted)) == sorted(token_counts.Counter(tokenizer).counts([r.text or "" for r in odd.collect()]))
    digests = queries.token_file_digests(odd).collect()
    assert len(digests) == odd.count()
    in_order = sorted(digests, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == sorted((r.doc_id for r in odd.collect()), key=lambda x: (x is None, x or 0))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(in_order, in_order[1:]))
    assert token_counts.token_counts(none, tokenizer).collect() == [] and queries.token_file_digests(none).collect() == []


def test_workers_do_not_keep_what_is_no_longer_used(tokenizer):
    """The tasks of other operators drop the encoder, and the word hashes of bags go with their task."""
    batch = pa.RecordBatch.from_pydict({"content": [b"x"], "text": ["one two three"]})
    token_files.Encoder.of(tokenizer)
    assert token_files.Encoder.of(tokenizer) is token_files.Encoder.of(tokenizer)
    list(bagminhash._bags(iter([batch])))
    assert not bagminhash._WORDS and not token_files.Encoder._loaded
    token_files.Encoder.of(tokenizer)
    list(common.in_slices(lambda b: b)(iter([batch])))
    assert not token_files.Encoder._loaded


def test_index_is_written_from_short_batches(spark, monkeypatch):
    """A batch is held whole by executor and worker; the session's own setting comes back."""
    name, seen, save = "spark.sql.execution.arrow.maxRecordsPerBatch", [], token_files.saved

    def watched(df, label):
        rows = spark.range(3000, numPartitions=1).mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long")
        seen.append(max(r.n for r in rows.collect()))
        return save(df, label)

    monkeypatch.setattr(token_files, "saved", watched)
    before = spark.conf.get(name)
    queries.op4_token_files(spark, SMALL)
    assert seen and seen[0] <= common.PYTHON_ROWS and spark.conf.get(name) == before
