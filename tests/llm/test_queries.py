"""Every registered query and every stage of the pipeline on whole small tables, column by column against plain loops."""

import hashlib
import struct
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import tiktoken
import tiktoken.load
import tokenizers

import __spark_entry__ as entry
import corpus_pipeline
from motionframe.llm import media, pii, quality
from motionframe.llm.queries_rows import vocabulary
from motionframe.llm.queries_scores import RULES
from motionframe.llm.queries_texts import KEY

SF = "/root/testdata/sf0.001"
TEXT = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}
sha = lambda b: hashlib.sha256(b).hexdigest()


def result(spark, name):
    return entry.queries()[name](spark, SF).collect()


def test_op1(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    ids = np.array([r["vec_id"] for r in table])
    x = np.array([r["embedding"] for r in table], np.float64)
    rows = result(spark, "op1_neighbours")
    asked = [i for i in ids if i % 20 == 0]
    assert len(rows) == 20 * len(asked)
    hits = 0
    for q in asked:
        mine = sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)
        score = x @ x[np.flatnonzero(ids == q)[0]]
        assert [r.rank for r in mine] == list(range(1, 21)) and all(abs(score[np.flatnonzero(ids == r.vec_id)[0]] - r.score) < 1e-12 for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine) and q not in [r.vec_id for r in mine]
        best = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-score[i], ids[i]))[:20]
        hits += len({r.vec_id for r in mine} & {ids[i] for i in best})
    assert hits >= 0.9 * len(rows)


def test_op2(spark):
    rows = {r.doc_id: r for r in result(spark, "op2_quality")}
    assert rows.keys() == TEXT.keys()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_op4(spark):
    rows = {r.doc_id: r for r in result(spark, "op4_media_columns")}
    assert rows.keys() == TEXT.keys()
    for i, text in TEXT.items():
        raw, r = text.encode(), rows[i]
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        stored = media.write(payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) == (len(raw), len(payload), sha(payload), zlib.crc32(payload[-64:]), len(stored), sha(stored))
        frames = len(payload) // 64
        first = stored.index(payload)
        assert r.feature == f"ipcm|8000|{len(payload) / 8000:.3f}|{frames}|{-(-frames // 256)}|{first}-{first + 64}"


def test_op7(spark):
    rows = {r.page_id: r for r in result(spark, "op7_url_filter")}
    pages = pq.read_table(f"{SF}/pages.parquet", columns=["page_id", "url"]).to_pylist()
    assert rows.keys() == {p["page_id"] for p in pages}
    for p in pages:
        rest = (p["url"] or "").partition("://")[2]
        host = rest.split("/")[0].split("?")[0].split("#")[0]
        path = rest[len(host) :].split("?")[0].split("#")[0]
        fit = [r for r in RULES if (host.lower() == r.host or host.lower().endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fit, key=lambda r: len(r.text), default=None)
        r = rows[p["page_id"]]
        assert (r.host, r.path, r.rule) == (host.lower(), path, rule and rule.text) and r.verdict == (rule.verdict if rule else r.verdict) and r.verdict in ("allow", "block")


def test_op8(spark):
    rows = {r.doc_id: r for r in result(spark, "op8_surrogates")}
    assert rows.keys() == TEXT.keys()
    new, originals = {}, {x[:2] for t in TEXT.values() for x in pii.entities_of(t)}
    for i, text in TEXT.items():
        at, parts = 0, []
        for (kind, canon, a, b, _), e in zip(pii.entities_of(text), rows[i].entities, strict=True):
            parts += [text[at:a], e.surrogate]
            at = b
            fake = pii.entities_of(e.surrogate)[0][1] if kind not in ("given", "family") else e.surrogate
            assert e.kind == kind and new.setdefault((kind, canon), fake) == fake and (kind, fake) not in originals
        assert rows[i].text == "".join([*parts, text[at:]]) and rows[i].n_entities == len(rows[i].entities)
    assert len({(k, v) for (k, _), v in new.items()}) == len(new)


def test_op9(spark):
    ranks = tiktoken.load.load_tiktoken_bpe(vocabulary("byte_bpe_multi_50k.tiktoken"))
    import public_tokenizers

    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r.doc_id: r for r in result(spark, "op9_bpe")}
    assert rows.keys() == TEXT.keys()
    for i, text in TEXT.items():
        ids = library.encode_ordinary(text)
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(text.encode()))


def check_pieces(rows, texts):
    library = tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    of, sequences = {}, {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert of.keys() == texts.keys()
    for i, text in texts.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        mine = sorted(of[i], key=lambda r: r.piece)
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)]
        assert [(r.piece, r.start, r.length) for r in mine] == [(k, a, (first if k == 0 else 1024)) for k, a in enumerate(starts)]
        assert all(r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.start : r.start + r.length])) for r in mine)
    for row in sequences.values():
        at = 0
        for r in sorted(row, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    total = sum(r.length for r in rows)
    assert len(sequences) <= max(-(-total // 1024) + 1, 1.01 * total / 1024)


def test_op10(spark):
    check_pieces(result(spark, "op10_packing"), TEXT)


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage."""
    from motionframe.llm.frames import table, written

    docs, out = table(spark, SF, "documents"), []
    out.append(docs.collect())
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF))
        out.append(docs.collect())
    return out


def test_stages_in_turn(spark, stages):
    texts = [{r.doc_id: r.text or "" for r in rows} for rows in stages[:-1]]
    # quality: the rows that the model, fitted on the labels, doesn't reject
    from motionframe.llm.frames import table

    docs = table(spark, SF, "documents")
    scored = {r.doc_id: r.predicted for r in quality.score(docs, quality.train(docs, table(spark, SF, "labels"))).collect()}
    assert texts[1] == {i: t for i, t in TEXT.items() if scored[i] == 1}
    # near duplicates: the least id of each group
    sets = {}
    for i, t in texts[1].items():
        w = "".join(c.lower() if c.isascii() else c for c in t).encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert texts[2] == {i: t for i, t in texts[1].items() if find(i) == i}
    # substrings: what windows of 13 words that start in a smaller id cover
    first, words = {}, {i: t.encode().split() for i, t in texts[2].items()}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k : k + 13]), i)
    for i, w in words.items():
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(k, k + 13)}
        assert texts[3][i].encode().split() == [x for k, x in enumerate(w) if k not in gone]
        assert gone or texts[3][i] == texts[2][i]
    # surrogates: no entity of the input is left, and the rest of the text stays
    originals = {x[:2] for t in texts[3].values() for x in pii.entities_of(t)}
    for i, t in texts[4].items():
        before, after = pii.entities_of(texts[3][i]), pii.entities_of(t)
        assert not {x[:2] for x in after} & originals and (before != []) == (t != texts[3][i])
    assert all(list(r.asDict()) == list(corpus_pipeline.COLUMNS) for rows in stages[:-1] for r in rows[:1])
    assert all(r.n_chars == len(r.text) for r in stages[3] + stages[4] if r.text is not None)
    check_pieces(stages[5], texts[4])
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in stages[5])


def test_stages_of_odd_tables(spark):
    """No rows; nulls, repeated rows and ids, and columns of other names."""
    shape = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    good = TEXT[max(TEXT, key=lambda i: len(TEXT[i]))]
    rows = [(1, good, "en", "s", 1), (1, good, "en", "s", 1), (None, None, None, None, None), (2, "", "en", None, 0), (None, good, "de", "s", None)]
    for docs in (spark.createDataFrame([], shape), spark.createDataFrame(rows, shape)):
        for _, stage in corpus_pipeline.STAGES:
            docs = docs.selectExpr("*", "1 AS id", "'x' AS node") if "text" in docs.columns else docs
            docs = stage(spark, docs, SF)
            docs.collect()
    assert KEY and pii.pseudonymise(spark.createDataFrame(rows, shape), KEY).count() == len(rows)
