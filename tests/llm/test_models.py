"""Language ID, the SentencePiece codec and WARC round trips."""

import gzip
import hashlib
import io
import os
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from receiptflow.llm import warc
from receiptflow.llm.language_id import CONTEXT, CORE, LOWER, PAD, Network, identify, pooled, sample_labelled
from receiptflow.llm.queries import op6_language_id
from receiptflow.llm.sentencepiece_codec import Encoder, PieceModel, decode_ids, encode_texts
from receiptflow.llm.shared import fresh_path
from receiptflow.llm.words import utf8
from tests.llm.sql import equals_sql

MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = Network(["a", "b", "c"], hidden=3, seed=4)
    for layer in (net.ahead, net.back):
        layer.input, layer.inner = layer.input.astype(np.float64), layer.inner.astype(np.float64)
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    bytes_ = np.where(np.arange(4)[:, None] < [4, 2, 1], rng.integers(97, 123, (4, 3)), PAD).astype(np.int16)
    labels = np.array([0, 2, 1])

    def loss():
        p = plain_probabilities(net, bytes_)
        inside = bytes_ != PAD
        return -np.log(p[:, labels, np.arange(3)][inside]).sum() / inside.sum()

    for w, g in zip(net.weights(), net.gradients(bytes_, labels), strict=True):
        for at in {tuple(x) for x in rng.integers(0, w.shape, (12, w.ndim))} | ({(1, int(bytes_[0, 0]))} if w.shape[1] == 257 else set()):
            if w.shape[1] == 257 and at[1] == PAD:
                continue
            kept = w[at]
            w[at] = kept + 1e-5
            more = loss()
            w[at] = kept - 1e-5
            less = loss()
            w[at] = kept
            assert abs((more - less) / 2e-5 - g[at]) < 1e-6


def plain_states(d, row):
    """One row of bytes, one byte after the other."""
    h, state, out = d.hidden, np.zeros(d.hidden), []
    for byte in row:
        x = d.input[:, byte].astype(float)
        u, r = 1 / (1 + np.exp(-(x[:h] + d.inner[:h] @ state))), 1 / (1 + np.exp(-(x[h : 2 * h] + d.inner[h : 2 * h] @ state)))
        state = u * state + (1 - u) * np.tanh(x[2 * h :] + d.inner[2 * h :] @ (r * state))
        out.append(state)
    return np.array(out)


def plain_probabilities(net, bytes_):
    out = np.empty((len(bytes_), len(net.languages), bytes_.shape[1]))
    for n, row in enumerate(bytes_.T):
        both = np.concatenate([plain_states(net.ahead, row), plain_states(net.back, row[::-1])[::-1]], 1)
        p = np.exp(both @ net.out.T.astype(float) + net.bias.T)
        out[:, :, n] = p / p.sum(1, keepdims=True)
    return out


def test_every_byte_of_whole_texts_is_labelled():
    """Against a byte-by-byte restatement over windows with what stands before and behind them."""
    rng = random.Random(1)
    texts = ["", "a", "Ab 1!", "é" * 300, "x" * CORE, "y" * (CORE + 1)] + ["".join(rng.choices("abcdé \n", k=rng.randint(1, 2000))) for _ in range(8)]
    net = Network(["a", "b"], hidden=4, seed=3)
    data, offsets = utf8(pa.array(texts))
    got = pooled(net, LOWER[data], offsets, rows=3)
    for k, text in enumerate(texts):
        raw = text.encode().lower()
        want = np.zeros(2)
        for c in range(0, len(raw), CORE):
            a, b = max(0, c - CONTEXT), min(len(raw), c + CORE + CONTEXT)
            p = plain_probabilities(net, np.frombuffer(raw[a:b], np.uint8)[:, None])[:, :, 0]
            want += p[c - a : min(len(raw), c + CORE) - a].sum(0)
        assert got[k] == pytest.approx(want, rel=1e-4) and got[k].sum() == pytest.approx(len(raw), rel=1e-4)


def test_held_out_languages_of_the_tables(spark):
    """The contract's fold, by language."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("lang IS NOT NULL AND text IS NOT NULL")
    found = op6_language_id(spark, sf).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    right, all_ = Counter(r.lang for r in found if r.lang == r.lang_pred), Counter(r.lang for r in found)
    print({k: f"{right[k]} of {n}" for k, n in all_.items()})
    assert len(all_) == 4 and all(right[k] >= 0.97 * n for k, n in all_.items())
    fold = {r.doc_id for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert {r.doc_id for r in found} == fold


def test_language_id_held_out_and_edges(spark):
    rng = random.Random(3)
    alphabets = {"xx": "abcdeé", "yy": "defghi", "zz": "ghijkl"}

    def text(lang):
        return " ".join("".join(rng.choices(alphabets[lang], k=rng.randint(2, 9))) for _ in range(40))

    rows = [(k, text(lang), lang) for k, lang in enumerate(rng.choices(list(alphabets), k=300))]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    edge = [(-1, None, None), (-2, "", "xx"), (-3, "12 !? €", "xx"), (-4, text("zz") * 200, "yy"), (-4, None, None)]
    asked = spark.createDataFrame(rows[200:] + edge, table.schema).withColumnRenamed("lang", "LANG_PRED").selectExpr("*", "1 AS score")
    got = identify(asked, table.filter("doc_id < 200").union(spark.createDataFrame(edge[:3], table.schema)))
    found = [(r.doc_id, r.lang_pred, r.score) for r in got.collect()]
    assert len(found) == 105 and all(0 <= s <= 1 for _, _, s in found)
    want = {k: lang for k, _, lang in rows} | {-1: "und", -2: "und", -3: "und"}
    right = [want[k] == p for k, p, _ in found if k != -4]
    assert sum(right) >= 0.95 * len(right)
    assert sorted(p for k, p, _ in found if k == -4) == ["und", "zz"]
    none = identify(table.limit(2), table.limit(0)).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)] * 2
    assert identify(table.limit(0), table).count() == 0


PARTS = ["the", "ing", " ", "  ", "a", "t", "io", "\n", ".", "é", "日", "本", "🎉", "er", "un", "ation", "1", "23", "<s>", "<0x41>", "\x00", "ﬁ", "\t"]


@pytest.mark.skipif(not os.path.exists(MODEL), reason="the public tokenizer file is not here")
def test_codec_equals_the_library(spark):
    import sentencepiece

    rng = random.Random(1)
    texts = [None, "", " ", "   ", "▁ x▁▁y", "x" * 5000, " " * 70 + "z", "word " * 3000, "日本語" * 500]
    texts += ["".join(rng.choices(PARTS, k=rng.randint(1, 60))) for _ in range(400)] + ["same text"] * 3
    rows = list(enumerate(texts))
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS IDS")
    back = decode_ids(encode_texts(table, MODEL, decoded="again"), MODEL)
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in back.collect()}
    assert len(got) == len(texts)
    for k, text in rows:
        want = None if text is None else own.encode(text)
        assert got[k].ids == want, (text, got[k].ids, want)
        assert got[k].decoded == (None if text is None else text.replace("▁", " "))
        assert got[k].n_tokens == len(want or []) and got[k].again == got[k].decoded
    assert encode_texts(table.limit(0), MODEL).count() == 0


@pytest.mark.skipif(not os.path.exists(MODEL), reason="the public tokenizer file is not here")
def test_long_segments_equal_the_library():
    """Texts without spaces: of words, of random letters, of other scripts, and such that repeat themselves out of step."""
    import sentencepiece

    rng = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = ["".join(rng.choice(PARTS).replace(" ", "") for _ in range(9000)), "".join(rng.choices(letters, k=150_000)), "a" * 30_000, "ab" * 9000]
    texts += ["=" * 9000 + "-" * 9001, "aab" * 5001, "日本語テスト" * 2500, "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(9000)), "\u0378" * 3000 + "x" * 6000]
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoder = Encoder(PieceModel.load(MODEL))
    for text in texts:
        assert encoder.encode(pa.array([text])).to_pylist() == [own.encode(text)], text[:60]
    began = time.process_time()
    text = "".join(rng.choices(letters, k=2_000_000))
    assert len(encoder.encode(pa.array([text]))[0]) > 500_000 and time.process_time() - began < 40


def test_every_occurrence_of_a_text_is_indexed(monkeypatch):
    """The indexed text is the whole batch: copies and repeated segments too, and nothing is kept from batch to batch."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoder = Encoder(PieceModel.load(MODEL))
    sizes = []
    index = Encoder._edges
    monkeypatch.setattr(Encoder, "_edges", lambda self, text, n: sizes.append(n) or index(self, text, n))
    texts = ["one two one two", "two one", "one two one two", None, "", "two"] * 3
    expected = [own.encode(x or "") for x in texts]
    for _ in range(2):
        assert encoder.encode(pa.array(texts)).to_pylist() == expected
    whole = sum(len(x) + 1 + len(x.split()) for x in texts if x)  # a space in front, and a byte behind each segment
    assert sizes == [whole, whole]


@pytest.mark.skipif(not os.path.exists(MODEL), reason="the public tokenizer file is not here")
def test_suffixes_are_in_full_order():
    encoder = Encoder(PieceModel.load(MODEL))
    rng = random.Random(8)
    text = "".join(rng.choices("ab", k=400)) + "ab" * 200 + "a" * 100
    raw = np.frombuffer(text.encode() + b"\xff" * encoder.depth, np.uint8)
    got = encoder._suffixes(raw, np.arange(len(text)))
    cut = [raw[i : i + encoder.depth].tobytes() for i in got.tolist()]
    assert cut == sorted(cut) and sorted(got.tolist()) == list(range(len(text)))


@pytest.mark.skipif(not os.path.exists(MODEL), reason="the public tokenizer file is not here")
def test_decodes_any_ids_like_the_library(spark):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(2)
    rows = [([rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(9)],) for _ in range(100)]
    rows += [([rng.randrange(3, 259) for _ in range(9)],) for _ in range(200)]
    rows += [([3 + b for b in x],) for x in (b"\xe2\x82", b"a\xe2\x82b", b"\xf0\x9f\x8e", b"\xc0\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xe2\x82\xac\xe2")]
    rows += [([],), (None,), ([1, 259 + 40, 2],), ([3 + 0xE2, 1, 3 + 0x82, 3 + 0xAC],), ([0, 300],), ([300, 0],), ([3 + 0x20, 300],), ([1, 3 + 0x20],)]
    got = [r.decoded for r in decode_ids(spark.createDataFrame(rows, "ids array<int>"), MODEL).collect()]
    assert got == [None if r[0] is None else own.decode(r[0]) for r in rows]


def test_merges_across_borders_match_whole_encoding():
    if not os.path.exists(MODEL):
        pytest.skip("the public tokenizer file is not here")
    from receiptflow.llm.sentencepiece_codec import merge_steps

    model = PieceModel.load(MODEL)
    rng = random.Random(4)
    usable = [k for k in model.steps if model.pieces[k].isascii()]
    for _ in range(3000):
        a, b = rng.choice(usable), rng.choice(usable)
        symbols, _ = merge_steps(model.pieces[a] + model.pieces[b], model.ids, model.scores)
        assert model.stays(a, b) == (symbols == [model.pieces[a], model.pieces[b]])


def brute_archive(rows, least=100):
    first = {}
    for k, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and k is not None:
            first[data] = min(k, first.get(data, k))
    out = []
    for k, _, html in rows:
        data = (html or "").encode()
        origin = first.get(data)
        revisit = origin is not None and k != origin
        out.append((k, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", origin if revisit else None))
    return out


def test_archives_round_trip(spark):
    page = "<p>" + "é" * 100 + "\r\n\r\nWARC/1.1\r\n\r\n"
    rows = [
        (5, "http://a/", page), (3, "http://b/\r\nX: y", page), (3, None, page), (None, "u", page), (9, "c", "short"), (8, "c", "short"),
        (1, "d", None), (2, "e", ""), (7, "f", "x" * 3_000_000), (6, "f", "x" * 3_000_000), (None, "g", "y" * 200), (None, "g", "y" * 200),
    ]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS archive", "2 AS __n")
    got = warc.archive_pages(table.repartition(3)).collect()
    key = repr
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=key) == sorted(brute_archive(rows), key=key)
    (folder,) = {r.archive.removeprefix("file://").rsplit("/", 1)[0] for r in got}
    assert {x.split("-")[0] for x in os.listdir(folder)} == {"members"}  # the streams they were made from are gone
    assert warc.archive_pages(table.limit(0)).count() == 0


def test_members_stand_at_their_offsets(spark):
    folder = fresh_path(spark, "warc-test")
    rows = [(k, f"http://h/{k}", "text %d " % k * 50) for k in range(20)]
    files = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder, file_bytes=4000)
    assert files.count() > 2
    indexed = warc.normalise(files, folder)
    for row in files.collect():
        raw = open(row.archive.removeprefix("file://"), "rb").read()
        assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == row.records
    for row in indexed.collect():
        raw = open(row.archive.removeprefix("file://"), "rb").read()
        lines = open(row["index"].removeprefix("file://")).read().splitlines()
        assert len(lines) == row.records
    for r in warc.read_archives(indexed).collect():
        raw = open(r.archive.removeprefix("file://"), "rb").read()[r.offset : r.offset + r.length]
        assert b"WARC-Page-ID: " + r.page_id.encode() + b"\r\n" in gzip.decompress(raw)


def test_streams_of_members_and_cut_streams():
    record = warc.page_record(1, None, "x" * 100, "d", None, "2020-01-01T00:00:00Z").encoded()
    many = gzip.compress(record) + gzip.compress(record * 2)
    assert len(list(warc.parsed(warc.inflated(io.BytesIO(many))))) == 3
    assert list(warc.parsed(warc.inflated(io.BytesIO(b"")))) == []
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parsed(warc.inflated(io.BytesIO(many[:-20]))))
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.parsed(iter([record[:-10]])))


def test_every_label_is_sampled_and_copies_count_once(spark):
    rows = [(f"text {k} of label {n}", f"l{n:02}") for n in range(70) for k in range(2)] + [("a hot text", "zz")] * 500
    sample = sample_labelled(spark.createDataFrame(rows, "text string, lang string"), "text", "lang", per_language=300, language_chars=2000)
    langs = sample.column("lang").to_pylist()
    assert len(set(langs)) == 71 and langs.count("zz") == 1 and len(langs) == 141


def test_samples_are_whole_texts_within_their_room(spark):
    rows = [("x" * 50_000, "a"), ("y" * 300, "a"), ("z" * 300, "a"), ("w" * 90_000, "b")] + [(f"{k:03}" * 100, "c") for k in range(40)]
    sample = sample_labelled(spark.createDataFrame(rows, "text string, lang string"), "text", "lang", per_language=300, language_chars=3000).to_pylist()
    assert {x["text"] for x in sample} <= {x[0] for x in rows}
    assert sorted(len(x["text"]) for x in sample if x["lang"] == "a") == [300, 300]
    assert [len(x["text"]) for x in sample if x["lang"] == "b"] == [90_000] and sum(x["lang"] == "c" for x in sample) == 10


def test_paths_of_stores():
    names = {"s3a://b/x": "s3://b/x", "dbfs:/tmp/x": "file:///dbfs/tmp/x", "file:/a/b": "file:///a/b", "file:///a": "file:///a", "hdfs://n/x": "hdfs://n/x"}
    assert {k: warc.located(k) for k in names} == names


def test_warc_query_equals_its_sql(spark):
    equals_sql(spark, "op7_warc", "/root/testdata/sf0.001")
