"""Operators on single texts: byte-level BPE, packing, media files, archives, surrogates."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from motionframe.llm import bpe, media, packing, pii, pretokens, warc, words
from motionframe.llm.queries_texts import op3_warc

P = pytest.importorskip("public_tokenizers")
PATTERN = regex.compile(P.PATTERN)
ALPHABET = "ab sS'’'retvldm12 \n\t  ..!é 　Ⅷ½_-中"
DOCS = "doc_id bigint, text string, extra string, ids int"


def pretokens_of(texts):
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(x) for x in texts])
    starts = np.cumsum(sizes) - sizes
    start = pretokens.cut(points, np.unique(starts[sizes > 0])) if len(points) else np.zeros(0, int)
    end = np.append(start[1:], len(points))
    joined = "".join(texts)
    return [joined[a:b] for a, b in zip(start, end)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=10), max_size=4))
def test_pretokens_are_those_of_the_pattern(texts):
    assert pretokens_of(texts) == [x for t in texts for x in PATTERN.findall(t)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab \t\nÄ中", max_size=30), max_size=5), st.booleans())
def test_words_are_cut_at_ascii_white_space_and_hashed_by_content(texts, lower):
    hashes, begin, end, firsts, data = words.Hasher(lower=lower).batch(pa.array(texts, pa.string()))
    raw = [t.encode().lower().split() if lower else t.encode().split() for t in texts]
    got = [bytes(data[a:b]) for a, b in zip(begin, end)]
    assert [w.lower() if lower else w for w in got] == [w for ws in raw for w in ws]
    assert list(np.diff(firsts)) == [len(ws) for ws in raw]
    flat = [w for ws in raw for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat))


def tiktoken_encoding(name):
    import tiktoken

    ranks = {t: r for r, t in enumerate(bpe.read_ranks(P.path(name)))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


EDGES = ["", None, " ", "\n\n", "it's I'll we've 'tis", "naïve 中文 🙂🙂 \x1c\x85 x", "<|endoftext|> a", "a" * 5000, "word " * 4000, "\u2047 ⁇"]


def test_bpe_equals_tiktoken_and_decodes(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    rows = [(i, t, "x", i) for i, t in enumerate(EDGES)] + [(None, "a b", None, None), (0, "", "again", 1)]
    out = bpe.decode(bpe.encode(spark.createDataFrame(rows, DOCS), path), path).collect()
    wanted = tiktoken_encoding("byte_bpe_multi_50k.tiktoken")
    assert len(out) == len(rows)
    texts = dict((r[0], r[1]) for r in rows)
    for r in out:
        text = texts[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == wanted.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()


def test_bpe_of_no_rows(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    assert bpe.encode(spark.createDataFrame([], DOCS), path, decoded=True).collect() == []


def test_pieces_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [(i, t, "x", i) for i, t in enumerate(EDGES)]
    got = packing.pieces(spark.createDataFrame(rows, DOCS), path).collect()
    for i, text in enumerate(EDGES):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        assert [x for r in mine for x in np.frombuffer(r.ids, "<u4").tolist()] == ids
        assert [r.start for r in mine] == list(itertools.accumulate([0] + [r.length for r in mine[:-1]]))
        assert all(r.length == 1024 for r in mine[1:]) and 1 <= mine[0].length <= 1024
        assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in mine)


def fewest(items, capacity):
    """Rows that a best packing needs, by search."""
    items = sorted(items, reverse=True)
    best = len(items)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
            place(i + 1, rooms[:k] + [rooms[k] - items[i]] + rooms[k + 1 :])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_dominance_keeps_a_best_packing(items):
    counts = np.bincount(np.array(items, int), minlength=21)
    fixed = packing.reduce(counts, 20)
    left = [x for x in range(21) for _ in range(counts[x])]
    assert sorted([x for row, n in fixed for x in row * n] + left) == sorted(items)
    assert all(sum(row) <= 20 for row, _ in fixed)
    assert sum(n for _, n in fixed) + fewest(left, 20) == fewest(items, 20)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_plan_holds_all_and_is_near_the_bound(items):
    counts = {x: items.count(x) for x in set(items)}
    rows = packing.plan(counts, 64)
    assert sorted(x for row, n in rows for x in row * n) == sorted(items)
    assert all(sum(row) <= 64 for row, _ in rows)
    assert sum(n for _, n in rows) <= -(-sum(items) * 11 // (64 * 9)) + 1


def test_pack_fills_rows_without_gaps(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), 0, int(n), "x") for i, n in enumerate(rng.integers(1, 1025, 3000))] + [(None, 0, 7, "y"), (5, 1, None, "z"), (6, 1, 0, "z"), (7, 1, 2000, "z"), (8, 0, 5, "x"), (8, 0, 5, "x")]
    out = packing.pack(spark.createDataFrame(rows, "doc_id bigint, piece int, length bigint, offset string")).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        if r.length is None or not 1 <= r.length <= 1024:
            assert r.sequence_id is None and r.offset is None
        else:
            by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r[2] for r in rows if r[2] and 1 <= r[2] <= 1024)
    assert len(by) <= total / 1024 * 1.02 + 2
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, piece int, length bigint")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=0, max_size=3000), st.integers(0, 3))
def test_media_round_trip(data, more):
    payload = (data + bytes(64))[: (len(data) // 64 + 1) * 64] * (1 + 400 * more)
    file = media.write(payload)
    track = media.read(file)
    assert media.payload_of(file, track) == payload
    assert track["codec"] == "ipcm" and track["ticks"] == len(payload) and len(track["starts"]) == len(payload) // 64
    assert track["keys"].tolist() == list(range(0, len(payload) // 64, media.FRAMES_A_KEY))


def test_media_reader_survives_what_is_no_media():
    good = media.write(bytes(range(64)))
    assert media.read(b"") is None and media.read(b"\0" * 100) is None and media.read(good[:60]) is None
    # the tables are whole, the media data aren't: what is left of the payload is read
    assert media.payload_of(good[:-1], media.read(good[:-1])) == bytes(range(63))
    deep = b""
    for _ in range(3000):
        deep = media.box(b"moov", deep)
    assert media.read(deep) is None and len(media.walk(memoryview(deep))) == 16
    at = good.index(b"stsz")
    for fixed, n in ((64, (1 << 32) - 1), (0, (1 << 32) - 1), (1 << 31, 1), (0, 0)):
        track = media.read(good[: at + 8] + fixed.to_bytes(4, "big") + n.to_bytes(4, "big") + good[at + 16 :])
        assert track is None or len(track["starts"]) == n == 0
    at = good.index(b"stsc")
    assert media.read(good[: at + 12] + b"\xff" * 12 + good[at + 24 :]) is None
    for n in range(0, len(good), 7):
        media.read(good[:n])
    wide = good.replace(b"mdat", b"free")
    assert media.read(wide)["codec"] == "ipcm"


def test_probe_keeps_columns_and_nulls(spark):
    docs = spark.createDataFrame([(1, "abc", "k", 1), (2, None, None, 2), (3, "", "k", 3), (4, "é" * 40000, "k", 4), (None, "abc", "k", 5)], DOCS)
    got = {r.doc_id: r for r in media.probe(media.store(docs), payload=True).collect()}
    assert bytes(got[1].payload) == b"abc".ljust(64, b"\0") and got[1].n_bytes == 3 and bytes(got[None].media) == bytes(got[1].media)
    assert got[2].n_bytes == 0 and len(got[3].payload) == 64
    assert bytes(got[4].payload) == ("é" * 40000).encode() and got[4].duration_s == 10.0 and len(got[4].keyframe_ranges) == 5
    a, b = got[4].keyframe_ranges[1]
    assert bytes(got[4].media)[a:b] == ("é" * 32).encode()
    files = spark.createDataFrame([(1, b"no media", "c"), (2, None, "c")], "id int, media binary, codec string")
    assert [r.codec for r in media.probe(files).collect()] == [None, None]


def test_dechunked():
    assert warc.dechunked(b"3;x=1\r\nabc\r\n2\r\nde\r\n0\r\nTrailer: 1\r\n\r\n") == b"abcde"
    for broken in (b"", b"3\r\nab", b"zz\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"-1\r\n"):
        assert warc.dechunked(broken) is None


def test_headers_that_are_no_numbers():
    record = lambda **head: ("WARC/1.1\r\n" + "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in head.items()) + "\r\nabc\r\n\r\n").encode()
    good = record(WARC_Record_ID="<a>", WARC_Type="resource", Content_Length=3)
    assert [r[0] for r in warc.parsed(good + good)] == ["<a>", "<a>"]
    for size in ("x", "-3", "1e3", "9" * 40, "³"):
        assert [r[0] for r in warc.parsed(good + record(WARC_Record_ID="<b>", Content_Length=size) + good)] == ["<a>"]
    odd = list(warc.parsed(record(WARC_Record_ID="<b>", WARC_Type="response", WARC_Segment_Number="x", WARC_Segment_Total_Length="9" * 40, Content_Length=3)))
    assert [r[6:8] for r in odd] == [(0, 0)] and odd[0][10] == b"abc"


def test_archives_round_trip_with_segments_and_revisits(spark, tmp_path):
    big = "".join(chr(97 + i % 26) for i in range(5000)) + "\r\n\r\nWARC/1.1\r\né"
    rows = [(1, "http://a/", "same", "c"), (2, None, "same", "c"), (3, "http://b/\r\nx", None, "c"), (4, "http://c/", "", "c"), (5, "http://d/", big, "c"), (6, "u", big, "c"), (None, "u", "same", None), (7, "u", "once", "c"), (7, "u", "once", "c")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, block string")
    path = str(tmp_path / "a")
    warc.write(pages, path, segment=512, chunk=100, records_a_file=5)
    records = warc.records(spark, path)
    assert records.where("type = 'continuation'").count() >= 9
    got = {}
    for r in warc.reassembled(records).collect():
        assert r.complete
        got.setdefault(r.record_id, []).append(r)
    page = lambda n: got[f"<urn:page:{n}>"][0]
    assert page(1).type == "revisit" and page(1).refers_to == "<urn:page:2>" and bytes(page(2).payload) == b"same"
    assert page(3).type == "revisit" and page(4).payload == b""
    assert page(5).type == "revisit" and bytes(page(6).payload) == big.encode() and page(3).url == "http://b/x"
    assert len(got["<urn:page:7>"]) == 2 and page("").type == "response"
    lost = records.where("not (type = 'continuation' and number = 3)")
    assert [r.record_id for r in warc.reassembled(lost).collect() if not r.complete] == ["<urn:page:6>"]
    warc.write(pages, str(tmp_path / "b"), min_bytes=5)
    assert warc.records(spark, str(tmp_path / "b")).where("type = 'revisit'").count() == 1


def test_surrogates(spark):
    a = "Mail und.34@mail7.example.com, UND.34@MAIL7.EXAMPLE.COM; +1 (017) 555-7713 or +10175557713; 97.51.17.173, 4111 1111 1111 1111, г-жа Ольга Петрова, Mr. SMITH"
    rows = [(1, a, "x", 1), (2, "again und.34@mail7.example.com and 97.51.17.173", "x", 1), (3, None, "x", 1), (4, "", "x", 1), (None, "und.34@mail7.example.com", None, 1), (5, "plain words, 3 of 4.", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, entities string, n int")
    out = {r.doc_id: r for r in pii.pseudonymise(docs, b"k").collect()}
    mails = re.findall(r"[\w.]+@[\w.]+\w", out[1].text)
    assert mails[0].upper() == mails[1] and mails[0] in out[2].text and out[None].text == mails[0]
    for original in ("und.34", "017", "97.51", "4111 1111", "Ольга", "SMITH"):
        assert original not in out[1].text
    digits = [x["surrogate"] for x in out[1].entities if x["kind"] == "phone"]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", digits[0]) and re.sub(r"\D", "", digits[0]) == digits[1][1:]
    card = next(x["surrogate"] for x in out[1].entities if x["kind"] == "card")
    assert re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", card) and pii._luhn(card.replace(" ", "")) == 0
    lady = {x["kind"]: x["surrogate"] for x in out[1].entities if x["kind"] in ("given", "family") and not x["surrogate"].isascii()}
    assert f"г-жа {lady['given']} {lady['family']}" in out[1].text and lady["given"] in pii.GIVEN["CYRILLIC"]["f"] and lady["family"].endswith(("ина", "ова", "ева", "ская", "енко", "ук"))
    assert out[3].text is None and out[3].n_entities == 0 and out[4].text == "" and out[5].text == rows[-1][1]
    for r in out.values():
        assert all(r.text[x["start"] :].startswith(x["surrogate"]) for x in r.entities)
    assert pii.pseudonymise(docs.limit(0), b"k").collect() == []


def test_neighbouring_entities_are_told_apart():
    text = "+1 (826) 555-4081 190.137.223.204 4845168114407329 +1 (826) 555-4081. 9807915762804490 1.2.3 2020-10-11"
    assert [(kind, text[a:b]) for kind, a, b in pii.find(text)] == [("phone", "+1 (826) 555-4081"), ("ip", "190.137.223.204"), ("card", "4845168114407329"), ("phone", "+1 (826) 555-4081")]


def test_surrogates_never_clash(spark, monkeypatch):
    real = pii.surrogate
    monkeypatch.setattr(pii, "surrogate", lambda kind, canon, key, attempt=0: "9.9.9.9" if attempt == 0 else real(kind, canon, key, attempt))
    values = [f"10.0.0.{i}" for i in range(1, 6)]
    entities = spark.createDataFrame([("ip", v) for v in values], "kind string, canon string")
    late = {r.canon: r.attempt for r in pii.settled(entities, b"k").collect()}
    fakes = [pii.surrogate("ip", v, b"k", late.get(v, 0)) for v in values]
    assert len(set(fakes)) == 5 and not set(fakes) & set(values) and len(late) == 4


def test_more_names_than_a_pool_holds(spark):
    def words(letters, n):
        return ["".join(w).capitalize() for w in itertools.islice(itertools.product(letters, repeat=4), n)]

    names = [f"Mr {w}" for w in words("bcdfghkl", 2600)] + [f"г-жа {w}" for w in words("бвгджзкл", 600)] + [f"κύριος {w}" for w in words("βγδζθκλμ", 300)]
    names += [f"Dr {w} Papp" for w in words("βγδζθκλμ", 600)]
    docs = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "doc_id bigint, text string")
    out = pii.pseudonymise(docs, b"k").collect()
    fakes = {r.text for r in out}
    assert len(out) == len(fakes) == len(names) and {r.n_entities for r in out} == {1, 2}
    assert not {f.split()[-1] for f in fakes} & {n.split()[-1] for n in names}


def replaced(spark, *texts):
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string")
    return [r.text for r in pii.pseudonymise(docs, b"k").orderBy("doc_id").collect()]


def test_persons_are_the_same_in_all_forms_of_their_name(spark):
    token = "ghp_aB3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0eF3hI6"
    full, short, doctor, shout, plain, both, lady, sir, ms, secret = replaced(
        spark, "Mr John Smith", "Mr Smith", "Dr John Smith", "MRS EMILY SMITH? Mrs EMILY SMITH", "Dear John Smith, call Anna", "John Smith and Anna Smith", "госпожа Иванова", "господин Иванов", "κυρία Παπαδοπούλου, κύριος Παπαδόπουλος", token
    )
    given, family = full.split()[1:]
    assert short == f"Mr {family}" and doctor == f"Dr {given} {family}" and plain.startswith(f"Dear {given} {family}, call") and both.startswith(f"{given} {family} and ") and both.endswith(family)
    assert shout.endswith(family.upper()) and given in pii.GIVEN["LATIN"]["m"]
    man = sir.split()[1]
    assert lady.split()[1] == next((man[: -len(m)] + w for m, w in pii.GENDERED if man.endswith(m)), man)
    woman, man = (x.split()[1] for x in ms.split(", "))
    assert woman == next(man[: -len(m)] + w for m, w in pii.GENDERED if man.endswith(m))
    assert len(secret) == len(token) and secret != token and [(c.isdigit(), c.isupper()) for c in secret] == [(c.isdigit(), c.isupper()) for c in token]
    clean = ["the value 123 456 7890 apples", "From 2010 2020 to 15 16 17", "Dear all, the Mark was paid", "Sir, no name"]
    assert replaced(spark, *clean) == clean
    assert [k for k, *_ in pii.find("call 212 555 0187 or 020 7946 0958 or +49 30 901820 or (030) 123 456")] == ["phone"] * 4


def test_surrogates_are_distinct_over_all_documents(spark):
    """Against plain loops over every mention: one surrogate an entity, no two the same, none an original."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bcdfgklm") + rng.choice("aeiou") for _ in range(3)).capitalize()
    texts = [f"{rng.choice(['Mr', 'Mrs', 'Dr'])} {word()} {word()}, {word().lower()}{rng.randrange(90)}@x.org and 10.{rng.randrange(9)}.0.{rng.randrange(9)}" for _ in range(300)]
    out = replaced(spark, *texts, *texts)
    assert out[:300] == out[300:]
    of = {}
    for before, after in zip(texts, out, strict=False):
        for (kind, canon, *_), (kind2, new, *_) in zip(pii.entities_of(before), pii.entities_of(after), strict=True):
            assert kind == kind2 and of.setdefault((kind, canon), new) == new
    assert len(set(of.items())) == len({(k, v) for (k, _), v in of.items()}) and not {(k, v) for (k, _), v in of.items()} & of.keys()


def test_archives_of_long_pages_with_repeated_and_null_ids(spark, tmp_path):
    import base64
    import hashlib

    long, other = "long page " * 20000, "another page " * 20000
    rows = [(9, "u", long), (9, "v", long), (9, "u", other), (3, "u", long), (4, "w", other), (4, "w", "short"), (None, "u", long), (None, "u", long), (None, "v", other), (5, "u", "once"), (5, "u", "once")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    keeper = {text: max(i for i, _, t in rows if t == text and i is not None) for _, _, text in rows}
    wanted = []
    for i, _, text in rows:
        revisit = i is not None and i != keeper[text]
        digest = base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
        wanted.append((i, len(text), digest, "revisit" if revisit else "response", keeper[text] if revisit else None, True))
    got = op3_warc(spark, str(tmp_path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete").collect()
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)
    warc.write(spark.read.parquet(str(tmp_path / "pages.parquet")), str(tmp_path / "a"))
    records = warc.records(spark, str(tmp_path / "a"))
    assert records.select("record_id").distinct().count() == records.count()
    ids = {r.record_id for r in records.collect()}
    assert {r.refers_to for r in records.where("refers_to is not null").collect()} <= ids
