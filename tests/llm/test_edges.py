"""Every registered operator on the awkward and on the empty tables, against
brute force."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as E
from statweave.llm import packing
from statweave.llm.queries import ORACLES, QUERIES

from .conftest import PAGE_ROWS, doc_rows

DOCS = [(r[0], r[1], r[2], r[3]) for r in doc_rows()]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def rows(spark, name, d):
    return [r.asDict() for r in QUERIES[name](spark, d).collect()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


def test_pipeline_empty_and_awkward(spark, empty_dir, edge_dir):
    run = E.queries()["pipeline"]
    assert run(spark, empty_dir).collect() == []
    assert len(run(spark, edge_dir).collect()) > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle_on_awkward_rows(spark, edge_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{edge_dir}/documents.parquet/*.parquet')")
    got = QUERIES[name](spark, edge_dir)
    res = con.execute(ORACLES[name])
    cols = [c[0] for c in res.description]
    want = Counter(tuple(str(v) for v in r) for r in res.fetchall())
    assert Counter(tuple(str(r[c]) for c in cols) for r in got.collect()) == want


def test_licenses_brute_force(spark, edge_dir):
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"],
               "reserved": ["all", "rights", "reserved"]}
    want = Counter()
    for i, t, *_ in DOCS:
        ws = FOLDED.findall(low(t))
        at = [(k, label) for label, p in phrases.items() for k in range(len(ws)) if ws[k:k + len(p)] == p]
        want[(i, len(ws), len(at), min((k for k, _ in at), default=None),
              max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at})))] += 1
    got = rows(spark, "op1_license_templates", edge_dir)
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"],
                    r["base_labels"]) for r in got) == want
    notice = next(r for r in got if r["doc_id"] == 109)
    assert notice["labels"] == "cc-by,cc-by-notice,reserved" and 0 < notice["score"] <= 1


def test_packing_round_trip(spark, edge_dir):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter()
    texts = {}
    for i, t, *_ in DOCS:
        texts[i] = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want[i] += len(texts[i])
    got = rows(spark, "op2_cost_packing", edge_dir)
    assert Counter({i: sum(r["length"] for r in got if r["doc_id"] == i) for i in want}) == want
    for r in got:
        ids = texts[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    sequences = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    padded = sum(1024 - n for n in sequences.values() if n & (n - 1))
    assert max(sequences.values()) <= 1024 and padded == 0


def test_encoder_equals_tokenizers():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["", " ", "a", " a  b", "a\n\n b\t c ", "x<|endoftext|>y z", "it's we'll DON'T", "\u00a0x \u2003y",
             "caf\u00e9\u0301 \U0001f600 \u6f22\u5b57 12a 3.5 ...", "end \n", "a,b. c.", "word. word, Word\nword",
             "\x00\x01 \x7f", "a \u0085b"]
    assert [list(x) for x in packing.public_byte_bpe()(texts)] == [
        tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_assignment_is_whole_and_balanced():
    rng = np.random.default_rng(1)
    lengths = [int(n) for n in rng.integers(1, 1023, 500)]
    caps, rest = packing.power_capacities(sum(lengths), 1024, True)
    assert rest == 0 and sum(caps) == sum(lengths)
    got = packing.assign(lengths, caps)
    assert sum(n for *_, n, _, _ in [(p, s, n, q, o) for p, s, n, q, o in got]) == sum(lengths)
    for i, n in enumerate(lengths):
        pieces = sorted((s, k) for p, s, k, _, _ in got if p == i)
        assert [s for s, _ in pieces] == [sum(k for _, k in pieces[:j]) for j in range(len(pieces))]
        assert sum(k for _, k in pieces) == n


def test_mixing_totals(spark, edge_dir):
    got = rows(spark, "op3_cube_mix", edge_dir)
    size = Counter()
    for _, t, _, s in DOCS:
        size[s] += len(WORD.findall(t or ""))
    total = sum(size.values())
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    target = {s: total * weight[s] / sum(weight.values()) for s in order}
    while over := [s for s in order if target[s] > 3 * size[s] + 1e-9]:
        excess = sum(target[s] - 3 * size[s] for s in over)
        for s in over:
            target[s] = 3 * size[s]
        free = [s for s in order if target[s] < 3 * size[s] - 1e-9]
        for s in free:
            target[s] += excess * weight[s] / sum(weight[x] for x in free)
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter(
        (i, len(WORD.findall(t or ""))) for i, t, *_ in DOCS)
    sources = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        sources.setdefault((r["source_size"], round(r["target"], 6)), []).append(r)
    assert Counter(k for k in sources) == Counter((size[s], round(target[s], 6)) for s in {
        (size[s], round(target[s], 6)): s for s in order}.values())
    again = rows(spark, "op3_cube_mix", edge_dir)
    assert Counter(map(str, got)) == Counter(map(str, again))


def test_simhash_brute_force(spark, edge_dir):
    fp = []
    for i, t, *_ in DOCS:
        ws = WORD.findall(low(t))
        sh = [" ".join(ws[k:k + 3]) for k in range(max(len(ws) - 2, 1))] if ws else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
        fp.append((i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    group = list(range(len(fp)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(fp)):
        for b in range(a):
            if (fp[a][1] ^ fp[b][1]).bit_count() <= 2:
                group[find(a)] = find(b)
    low_id = {}
    for k, (i, _) in enumerate(fp):
        if i is not None:
            low_id[find(k)] = min(low_id.get(find(k), i), i)
    want = Counter((i, f"{x:016x}", low_id.get(find(k))) for k, (i, x) in enumerate(fp))
    got = rows(spark, "op9_simhash", edge_dir)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def test_language_defined_cases(spark, edge_dir):
    got = {}
    for r in rows(spark, "op4_ppm_language", edge_dir):
        got.setdefault(r["doc_id"], r)
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    for i in (100, 101, 102, 107):
        assert got[i]["lang_pred"] == "und" and got[i]["score"] == 0
    assert all(got[i]["lang_pred"] == "en" for i in range(24))
    assert all(got[i]["lang_pred"] == "fr" for i in range(24, 40))


def test_urls_brute_force(spark, edge_dir):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]
    want = Counter()
    for i, url, _ in PAGE_ROWS:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = low(re.split(r"[/?#]", rest, maxsplit=1)[0])
            path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        fit = [(len(r), r, v) for v, r in rules for h, p in [r.split("/", 1)]
               if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        want[(i, host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "allow")] += 1
    got = rows(spark, "op5_host_reputation", edge_dir)
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == want


def test_main_text_expected(spark, edge_dir):
    got = {(r["page_id"], r["text"], r["n_chars"]) for r in rows(spark, "op8_host_suffix_array", edge_dir)}
    own = [f"own text number {i} of page {i} with enough words to stay {i}" for i in range(5)]
    texts = {0: "T & U\n\none two\n\nthree four", 1: "xy", 2: "plain page", 3: "", 4: "",
             5: "< 3 <b> fin", 6: "kept", None: "t", **{20 + i: t for i, t in enumerate(own)}}
    assert got == {(i, t, len(t)) for i, t in texts.items()}
    assert QUERIES["op8_host_suffix_array"](spark, edge_dir).count() == len(PAGE_ROWS)


def test_search_brute_force(spark, edge_dir):
    bags = [(i, Counter(FOLDED.findall(low(t)))) for i, t, *_ in DOCS]
    n = len(bags)
    df = Counter(w for _, b in bags for w in b)
    mean = sum(sum(b.values()) for _, b in bags) / n
    want = {}
    for q in {i for i, _ in bags if i is not None and i % 20 == 0}:
        # Of repeated ids the smallest text is the query.
        text = min((t or "" for i, t, *_ in DOCS if i == q))
        terms = set(FOLDED.findall(low(text)))
        scored = []
        for i, b in bags:
            s = sum(math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2
                    / (b[w] + 1.2 * (0.25 + 0.75 * sum(b.values()) / mean)) for w in terms if w in b)
            if s > 0:
                scored.append((-round(s, 6), math.inf if i is None else i))
        want[q] = sorted(scored)[:10]
    got = {}
    for r in rows(spark, "op7_block_max_wand", edge_dir):
        got.setdefault(r["query_id"], []).append(
            (r["rank"], -r["score"], math.inf if r["doc_id"] is None else r["doc_id"]))
    for q, expected in want.items():
        found = sorted(got.get(q, []))
        assert [d for _, _, d in found] == [d for _, d in expected], q
        assert np.allclose([s for _, s, _ in found], [s for s, _ in expected], atol=2e-6)


def test_toxicity_runs_on_awkward_rows(spark, edge_dir):
    got = rows(spark, "op10_classifier_chain", edge_dir)
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in DOCS)
    assert all(0 <= r["p_toxic"] <= 1 and 0 <= r["p_severe"] <= 1 for r in got)
