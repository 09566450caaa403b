"""Every query of the training-data operators against brute force on small tables."""

import collections
import hashlib
import itertools
import math
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

from threatframe.llm import queries
from threatframe.llm.common import table

SF = "/root/testdata/sf0.01"
WS = re.compile(r"[\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text or "") for r in table(spark, SF, "documents").select("doc_id", "text").collect()]


def by_id(spark, name, key="doc_id"):
    rows = queries.QUERIES[name](spark, SF).collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, name):
    status, *_ = compare(spark, connect(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert status == "ok", status


def test_url_filter_by_rule(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    got = by_id(spark, "op1_url_filter", "page_id")
    for r in table(spark, SF, "pages").collect():
        rest = r.url.split("://", 1)[1] if r.url and "://" in r.url else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = host.lower()
        fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda f: len(f[0])) if fits else (None, "allow")
        assert tuple(got[r.page_id]) == (r.page_id, host, path, rule, verdict)


def test_exact_dedup(spark, docs):
    groups = collections.defaultdict(list)
    for d, t in docs:
        groups[hashlib.sha256(WS.sub(" ", t).encode()).hexdigest()].append(d)
    got = by_id(spark, "op2_exact_dedup")
    assert len(got) == len(docs)
    for digest, ids in groups.items():
        for d in ids:
            assert tuple(got[d]) == (d, min(ids), len(ids), d == min(ids), digest)


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    want, total = {}, 0
    for d, t in docs:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [1]
        total += len(ids)
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[d, k] = (at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
    rows = queries.QUERIES["op3_best_fit_packing"](spark, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= math.ceil(total / 4096) + 1


def test_language_model(spark, docs):
    tokens = {d: t.encode().lower().split() + [None] for d, t in docs}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs}
    counts = collections.Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    got = by_id(spark, "op4_brown_lm")
    assert set(got) == set(tokens)
    for d, ws in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
    outside = [r for d, r in got.items() if held[d]]
    assert sum(r.score for r in outside) > sum(r.base_score for r in outside) * 0.97


def shingle_set(text):
    words = text.encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(docs):
    sets = {d: shingle_set(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = collections.defaultdict(set)
    for d, s in sets.items():
        for x in s:
            index[x].add(d)
    pairs = {p for ids in index.values() for p in itertools.combinations(sorted(ids), 2)}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            ra, rb = sorted((root(a), root(b)))
            parent[rb] = ra
    return {d: (len(sets[d]), root(d)) for d in sets}


def test_ngram_jaccard(spark, docs):
    got = by_id(spark, "op5_ngram_jaccard")
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == brute_components(docs)


def test_quality(spark, docs):
    got = by_id(spark, "op6_quality_cnn")
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    outside = [(labels[d], r) for d, r in got.items() if r.held_out and d in labels]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for d, r in got.items())
    assert len(got) == len(docs)
    good = [r.score for q, r in outside if q == 1]
    bad = [r.score for q, r in outside if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.93
    assert np.mean([r.predicted == q for q, r in outside]) > 0.93


def test_embeddings(spark):
    rows = table(spark, SF, "embeddings").collect()
    got = by_id(spark, "op8_embedding_dedup", "vec_id")
    links, parent = collections.Counter(), {r.vec_id: r.vec_id for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for label in {r.label for r in rows} - {None}:
        group = [r for r in rows if r.label == label]
        m = np.array([r.embedding for r in group], dtype=np.float64)
        m /= np.linalg.norm(m, axis=1)[:, None]
        for i, j in zip(*np.nonzero(np.triu(m @ m.T >= 0.93, 1)), strict=True):
            a, b = group[i].vec_id, group[j].vec_id
            links[a] += 1
            links[b] += 1
            ra, rb = sorted((root(a), root(b)))
            parent[rb] = ra
    assert {k: tuple(r)[1:] for k, r in got.items()} == {r.vec_id: (links[r.vec_id], root(r.vec_id), root(r.vec_id) == r.vec_id) for r in rows}


def test_byte_bpe(spark, docs):
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(spark, "op9_byte_bpe")
    for d, t in docs:
        ids = own.encode_ordinary(t)
        assert tuple(got[d]) == (d, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def base_spans(text):
    found = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 12:
            found.append((m.start(), 0, m.end(), "assign"))
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(found)


def test_secrets(spark, docs):
    got = by_id(spark, "op10_secret_scan")
    assert len(got) == len(docs)
    for d, t in docs:
        want, r = base_spans(t), got[d]
        listing = ",".join(f"{k}:{s}:{e}" for s, _, e, k in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x[3] for x in want) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(listing.encode()).hexdigest()
        spans = [x for x in r.spans.split(",") if x]
        assert [x for x in spans if not x.startswith("random")] == [x for x in listing.split(",") if x]


def test_html(spark):
    """All words of the visible part of the generator's pages, and none of the hidden parts."""
    got = by_id(spark, "op7_html_layout", "page_id")
    for r in table(spark, SF, "pages").collect():
        text = got[r.page_id].text
        assert "track(" not in text and "margin:0" not in text and "<" not in text.replace("< ", "")
        body = r.html[r.html.index("<body>"):] if "<body>" in r.html else r.html
        visible = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", " ", body, flags=re.S)
        import html

        words = collections.Counter(html.unescape(re.sub(r"<[^>]*>", " ", visible)).split())
        rendered = collections.Counter(text.split())
        missing = words - rendered
        assert sum(missing.values()) <= 0.02 * sum(words.values()) + 2, (r.page_id, missing.most_common(5))


def test_pipeline_stages(spark, tmp_path, docs):
    import corpus_pipeline

    rows, out = table(spark, SF, "documents"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, rows, SF).write.parquet(f"{tmp_path}/{k}")
        out.append(spark.read.parquet(f"{tmp_path}/{k}"))
        rows = out[-1]
    texts = [{r.doc_id: r.text for r in x.collect()} for x in out[:4]]
    assert all(x.columns == table(spark, SF, "documents").columns for x in out[:4])
    scores = {r.doc_id: r.predicted for r in queries.QUERIES["op6_quality_cnn"](spark, SF).collect()}
    assert set(texts[0]) == {d for d, p in scores.items() if p == 1}
    first = {}
    for d, t in sorted(texts[0].items()):
        first.setdefault(WS.sub(" ", t), d)
    assert set(texts[1]) == set(first.values())
    classes = brute_components(sorted(texts[1].items()))
    assert set(texts[2]) == {c for _, c in classes.values()}
    assert set(texts[3]) == set(texts[2])
    for d, t in texts[3].items():
        assert not base_spans(t) and (t == texts[2][d]) == (not base_spans(texts[2][d]) or t == texts[2][d])
    assert {r.doc_id for r in out[4].select("doc_id").distinct().collect()} == set(texts[3])
    assert out[4].agg(F.max("offset")).first()[0] < 4096
