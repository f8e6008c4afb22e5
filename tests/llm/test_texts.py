"""Secrets, line dedup, decontamination and packing against plain versions."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from compare import compare, duck
from conftest_llm import SMALL, frame, needs_tables, words
from spinledger.llm import decontamination, line_dedup, packing, secrets_scan
from spinledger.llm.line_dedup import LineIndex, without_repeated_lines
from spinledger.llm.suffix_automaton import SuffixAutomaton

# --- secrets -------------------------------------------------------------------

KEY = "AKIA" + "Z9" * 8
HEX = "0f" * 12


def base_spans(text):
    out = []
    for order, (kind, pattern, group, least) in enumerate(
        [
            ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20),
            ("hex", r"[0-9a-f]+", 0, 24),
        ]
    ):
        out += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(out))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["password", "TOKEN", "api_key", "apikey", "=", ":", " ", "'", '"', "abcdef", "ab", KEY, "AKIA", HEX, "f", "Ζ", "ſecret", "\n", "%20", "%3D", "."]), max_size=14))
def test_base_spans_equal_the_patterns(parts):
    text = "".join(parts)
    base, spans = secrets_scan.scan(text)
    assert secrets_scan.joined(base) == base_spans(text)
    assert set(base) <= set(spans)


def nested(text, layers):
    for layer in layers:
        if layer == "url":
            text = urllib.parse.quote(text, safe="")
        elif layer == "unicode":
            text = "".join(f"\\u{ord(char):04x}" for char in text)
        elif layer == "base64":
            text = base64.b64encode(text.encode()).decode()
        else:
            text = base64.b64encode(gzip.compress(text.encode(), mtime=0)).decode()
    return text


@pytest.mark.parametrize("layers", [["url"], ["unicode"], ["base64"], ["gzip"], ["url", "base64"], ["base64", "url", "base64"], ["unicode", "gzip", "base64", "url"]])
def test_secrets_below_layers(layers):
    hidden = nested("password=hunter2hunter2", layers)
    text = f"before {hidden} after"
    base, spans = secrets_scan.scan(text)
    assert any(kind == "assign" and 7 <= start and end <= 7 + len(hidden) for kind, start, end in spans)
    assert secrets_scan.redacted(text).startswith("before ") and "after" in secrets_scan.redacted(text)


def test_spans_of_decoded_characters_map_back():
    text = "x=%41KIA" + "B" * 16 + "%20end"
    assert secrets_scan.scan(text)[1] == [("access", 2, 2 + 7 + 16 - 1)] or ("access", 2, 24) in secrets_scan.scan(text)[1]


def test_damaged_and_endless_layers_end():
    for text in ("%%%25%25%2525" * 50, "A" * 5000, base64.b64encode(gzip.compress(b"x" * 99)[:-9]).decode(), "\\ud800\\udc00 &#1114112; %ff%fe"):
        secrets_scan.scan(text)


def kinds_at(text):
    return {(kind, text[start:end]) for kind, start, end in secrets_scan.scan(text)[1]}


@pytest.mark.parametrize(
    "text, whole",
    [
        (r"x \u0022password\u0022: \u0022hunter22\u0022 y", r"password\u0022: \u0022hunter22"),
        ("x, &#34;token&#34;: &#34;abcdef12&#34; y", "token&#34;: &#34;abcdef12"),
        ('api_key%3D "abcdef12"', 'api_key%3D "abcdef12'),
        ('so secret = "ab%2Bcdefgh", then', 'secret = "ab%2Bcdefgh'),
        ("pass%77ord = hunter22", "pass%77ord = hunter22"),
        ("Ärger, token %3A %22abcdef%22", "token %3A %22abcdef"),
        ("&#x73;ecret&#61;\\x61bcdef", "&#x73;ecret&#61;\\x61bcdef"),
    ],
)
def test_codes_among_plain_text(text, whole):
    assert ("assign", whole) in kinds_at(text)


def wrapped(data, width=76, end="\n", indent=""):
    word = base64.b64encode(data).decode()
    return end.join(indent + word[k : k + width] for k in range(0, len(word), width))


@pytest.mark.parametrize("end, indent", [("\n", ""), ("\r\n", ""), ("\n", "   ")])
def test_wrapped_words(end, indent):
    noise = "".join(chr(97 + k * k % 23) for k in range(150))
    for data in (f"{noise} password = hunter22 {noise}".encode(), gzip.compress(f"{noise}; password = hunter22".encode() * 3, mtime=0)):
        text = "Head: x" + end + wrapped(data, end=end, indent=indent) + end + "thanks" + end
        assert {kind for kind, _ in kinds_at(text)} == {"assign"}
    plain = "y" * 40 + " password=hunter22abc " + "z" * 60
    (kind, start, end_at), = secrets_scan.scan(wrapped(plain.encode(), end=end, indent=indent))[1]
    covered = re.sub(r"\s", "", wrapped(plain.encode(), end=end, indent=indent)[start:end_at])
    assert kind == "assign" and 28 <= len(covered) <= 32


def test_all_members_and_repeated_compression():
    first, second = gzip.compress(b"nothing here ", mtime=0), gzip.compress(b"token=abcdef12", mtime=0)
    for data in (first + second, bz2.compress(second), gzip.compress(bz2.compress(zlib.compress(b"token=abcdef12")), mtime=0), lzma.compress(b"\x00\xff token=abcdef12")):
        word = base64.b64encode(data).decode()
        assert ("assign", word.rstrip("=")) in {(kind, part.rstrip("=")) for kind, part in kinds_at(f"a {word} b")}


def test_large_and_damaged_compressed_layers(monkeypatch):
    monkeypatch.setattr(secrets_scan, "PIECE", 1000)
    rows = b"".join(b"row %d, nothing\n" % k for k in range(4000))
    for body in (b"token=abcdef12, " + rows, rows + b" token=abcdef12", rows + b"token = " + b"ghijkl" * 900):
        assert {kind for kind, _ in kinds_at(base64.b64encode(gzip.compress(body, mtime=0)).decode())} == {"assign"}
    cut = gzip.compress(b"token=abcdef12, " + rows, mtime=0)[:-2000]
    assert {kind for kind, _ in kinds_at(base64.b64encode(cut).decode())} >= {"assign"}


def test_long_text_with_deep_codes():
    deep = "%" + "25" * 40 + "3D"
    text = "word and, more. " * 20000 + f"api_key{deep}abcdef12, " + "plain text here. " * 20000
    assert ("assign", f"api_key{deep}abcdef12") in kinds_at(text)


def test_secrets_of_awkward_rows(spark, awkward):
    rows = secrets_scan.secrets_found(awkward).collect()
    assert len(rows) == 10 and all(row["spans"] == "" for row in rows)
    assert secrets_scan.secrets_found(frame(spark, [])).count() == 0


@needs_tables
def test_secrets_query(spark):
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for row in secrets_scan.op2_secrets(spark, SMALL).collect():
        expected = base_spans(texts[row["doc_id"]] or "")
        assert row["base_sha256"] == hashlib.sha256(expected.encode()).hexdigest()
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(expected.count(kind) for kind in ("assign", "access", "hex"))


# --- lines ---------------------------------------------------------------------


@needs_tables
@pytest.mark.parametrize("module, query", [(line_dedup, line_dedup.op7_line_dedup), (decontamination, decontamination.op8_decontamination)])
def test_query_equals_sql(spark, module, query):
    ours, theirs = compare(query(spark, SMALL), duck(SMALL), module.SQL)
    assert ours[0] == theirs[0] and ours[1] == theirs[1]


def test_lines_of_awkward_rows(spark, awkward):
    rows = without_repeated_lines(awkward, min_documents=3).collect()
    by_id = {}
    for row in rows:
        by_id.setdefault(row["doc_id"], []).append((row["text"], row["n_lines"], row["n_dropped"]))
    # Two rows of document 1 and one without id share a line; each row is a document.
    assert sorted(by_id[1]) == [("", 1, 1), ("", 1, 1), ("another text of the same id", 1, 0)]
    assert by_id[2] == [(None, 1, 0)] and by_id[3] == [("", 1, 0)] and by_id[4] == [(" \t\n\n ", 3, 0)]
    assert set(awkward.columns) - set(rows[0].asDict()) == set()
    assert without_repeated_lines(frame(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_lines_with_and_without_sent_filters(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "FILTER_LIMIT_BYTES", limit)
    rows = [(k, f"own {k}\n  SHARED line\t\n\nlast") for k in range(12)]
    got = without_repeated_lines(frame(spark, rows)).orderBy("doc_id").collect()
    assert [row["text"] for row in got] == [f"own {k}\n" for k in range(12)]
    assert {(row["n_lines"], row["n_dropped"]) for row in got} == {(4, 2)}


def test_index_is_reversible(spark, tmp_path):
    docs = frame(spark, [(k, "common\nrare %d" % (k % 6)) for k in range(12)])
    index = LineIndex(spark, str(tmp_path / "index"), min_documents=10, shards=4)
    index.insert(docs.where("doc_id < 9"))
    assert index.repeated().count() == 0
    index.insert(docs.where("doc_id >= 9"))
    assert index.repeated().count() == 1
    assert index.without_repeated_lines(docs).where("n_dropped = 1").count() == 12
    index.delete(docs.where("doc_id < 3"))
    assert index.repeated().count() == 0
    assert index.without_repeated_lines(docs).where("n_dropped > 0").count() == 0
    index.delete(docs.where("doc_id >= 3"))
    assert index.counts().count() == 0


# --- decontamination -----------------------------------------------------------


def brute_hits(text, items, window):
    def split(value):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), value or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    own, hit, names = split(text), set(), set()
    for name, item in items:
        target = split(item)
        size = min(window, len(target))
        wanted = {tuple(target[k : k + size]) for k in range(len(target) - size + 1)} if size else set()
        for k in range(len(own) - size + 1):
            if tuple(own[k : k + size]) in wanted:
                hit |= set(range(k, k + size))
                names.add(str(name))
    return len(own), len(hit), sorted(names)


@pytest.mark.parametrize("block_bytes", [4 << 20, 400])
def test_hits_equal_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
    rng = random.Random(5)
    vocabulary = words(rng, 12)
    texts = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 60))] for _ in range(60)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9)))) for k in range(25)]
    items += [(None, " ".join(vocabulary)), (90, None), (91, "!!"), (92, vocabulary[0]), (92, " ".join(texts[3]))]
    rows = [(k, "-".join(own)) for k, own in enumerate(texts)] + [(77, None)]
    got = decontamination.decontaminated(frame(spark, rows), frame(spark, items, "item_id bigint, text string"), 4, cut_text=False)
    named = [(name, text) for name, text in items if name is not None]
    for row in got.collect():
        assert (row["n_words"], row["n_hit"], row["items"]) == brute_hits(row["text"], named, 4)


def test_passages_are_cut_out(spark, awkward):
    items = frame(spark, [(7, "B c D")], "item_id bigint, text string")
    got = decontamination.decontaminated(frame(spark, [(1, "a b, c! d e"), (2, "é b c d"), (3, "b c"), (4, None)]), items, 3)
    assert {row["doc_id"]: row["text"] for row in got.collect()} == {1: "a  e", 2: "é ", 3: "b c", 4: None}
    assert decontamination.decontaminated(awkward, items).count() == 10
    assert decontamination.decontaminated(awkward, items.limit(0)).where("n_hit > 0").count() == 0


def test_automaton_finds_every_common_run():
    rng = random.Random(2)
    items = [[rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(8)]
    automaton = SuffixAutomaton(4)
    for k, item in enumerate(items):
        automaton.add(str(k), item)
    automaton.finish()
    text = [rng.randrange(3) for _ in range(300)]
    got = {(end, size, name) for end, size, names in automaton.matches(text) for name in names}
    expected = set()
    for k, item in enumerate(items):
        size = min(4, len(item))
        runs = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)}
        expected |= {(i + size - 1, size, str(k)) for i in range(len(text) - size + 1) if tuple(text[i : i + size]) in runs}
    assert got == expected


def test_line_index_goes_on_where_it_was_closed(spark, tmp_path):
    path = str(tmp_path / "index")
    for day in range(3):
        LineIndex(spark, path, min_documents=3, shards=2).insert(frame(spark, [(day, f"often\nonce {day}")]))
    again = LineIndex(spark, path, min_documents=3, shards=2)
    assert again.version == 3 and again.repeated().count() == 1
    with pytest.raises(ValueError, match="never inserted"):
        again.delete(frame(spark, [(9, "unknown")]))
    again.delete(frame(spark, [(0, "often\nonce 0")]))
    after = LineIndex(spark, path, min_documents=3, shards=2)
    assert after.version == 4 and after.repeated().count() == 0 and after.counts().count() == 3


# --- packing -------------------------------------------------------------------


def encoded(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    if not hasattr(encoded, "tokenizer"):
        encoded.tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab Z9é中'\n\t .,!_  　İ", max_size=40))
def test_encoder_equals_the_tokenizer(text):
    encoder = packing._encoder(packing.vocabulary_path())
    assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == encoded(text)[:-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "ab", " cd", "É"]), max_size=9))
def test_encoder_takes_added_tokens_as_the_tokenizer_does(parts):
    encoder = packing._encoder(packing.vocabulary_path())
    assert np.frombuffer(encoder.encode("".join(parts)), encoder.dtype).tolist() == encoded("".join(parts))[:-1]


def check_pieces(rows, texts, window=packing.WINDOW):
    """Pieces cover every document once and fill the sequences one after another."""
    pieces = sorted(rows, key=lambda row: (row["sequence_id"], row["offset"]))
    at = 0
    for row in pieces:
        assert row["sequence_id"] * window + row["offset"] == at
        at += row["length"]
    wanted = sorted(tuple(encoded(text)) for text in texts)
    whole = sorted((row["doc_tokens"] for row in pieces if row["start"] == 0))
    assert whole == sorted(map(len, wanted)) and at == sum(map(len, wanted))


@needs_tables
def test_packing_query(spark):
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = packing.op6_packing(spark, SMALL).collect()
    check_pieces(rows, texts.values())
    for row in rows:
        ids = np.array(encoded(texts[row["doc_id"]])[row["start"] : row["start"] + row["length"]], "<u4")
        assert (zlib.crc32(ids.tobytes()), len(ids)) == (row["ids_crc32"], row["length"])


def test_packing_of_awkward_rows(spark, awkward):
    texts = [row["text"] for row in awkward.collect()]
    check_pieces(packing.packed_pieces(awkward).collect(), texts)
    check_pieces(packing.packed_pieces(awkward.repartition(3), window=64).collect(), texts, 64)
    assert packing.packed_pieces(frame(spark, [])).count() == 0
