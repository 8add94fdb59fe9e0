"""The corpus queries against brute force and SQL on the smallest tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from html import unescape

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from check import connect, difference
from millrace.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()


def rows(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, FOLDER).collect()]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER).execute(ORACLES[name])) is None


def test_op1_budgets(spark, documents):
    got = rows(spark, "op1_mix_sources")
    source = {d["doc_id"]: d["source"] for d in documents}
    assert sorted(source) == sorted(r["doc_id"] for r in got)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
        largest[source[r["doc_id"]]] = max(largest[source[r["doc_id"]]], r["size"])
    for r in got:
        s = source[r["doc_id"]]
        assert abs(taken[s] - r["target"]) <= largest[s] / 2 + 1


def test_op2_base_and_gain(spark, documents):
    tokens = {d["doc_id"]: [*WORD.findall(lower(d["text"])), None] for d in documents}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = Counter(t for i, ts in tokens.items() if not held[i] for t in ts)
    n, v = sum(c.values()), len(c)
    got = rows(spark, "op2_score_texts")
    assert len(got) == len(documents)
    for r in got:
        ts = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(ts), n)
        assert r["n_known"] == sum(c[t] > 0 for t in ts)
        assert math.isclose(r["base_score"], sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), abs_tol=1e-6)
    assert sum(r["score"] for r in got if r["held_out"]) > sum(r["base_score"] for r in got if r["held_out"])


def test_op3_articles(spark):
    pages = {p["page_id"]: p for p in pq.read_table(f"{FOLDER}/pages.parquet").to_pylist()}
    got = rows(spark, "op3_extract_pages")
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]]["html"], re.DOTALL)[1]
        assert r["text"] == " ".join(unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert r["n_chars"] == len(r["text"])


def test_op4_accuracy(spark, documents):
    lang = {d["doc_id"]: d["lang"] for d in documents}
    got = rows(spark, "op4_language_id")
    assert len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"]]
    assert sum(held) >= 0.95 * len(held)


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(p) <= 255 for p in t.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda t: 12 <= len(re.sub("[ -]", "", t)) <= 19 and luhn(re.sub("[ -]", "", t))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= sum(c.isdigit() for c in t) <= 15),
}
SECRETS = {
    "assign": (r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def digest(spans, kinds):
    text = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0]))))
    return hashlib.sha256(text.encode()).hexdigest()


def pii_spans(text):
    return [(k, *m.span()) for k, (p, ok) in BASE.items() for m in re.finditer(p, text) if ok(m[0])]


def secret_spans(text):
    return [(k, *m.span()) for k, (p, ok) in SECRETS.items() for m in re.finditer(p, text) if ok(m)]


@pytest.mark.parametrize("name,find,kinds", [("op9_find_pii", pii_spans, list(BASE)), ("op5_find_secrets", secret_spans, list(SECRETS))])
def test_spans(spark, documents, name, find, kinds):
    text = {d["doc_id"]: d["text"] or "" for d in documents}
    got = rows(spark, name)
    assert len(got) == len(text)
    for r in got:
        spans = find(text[r["doc_id"]])
        assert r["base_sha256"] == digest(spans, kinds)
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r["spans"].split(",")) | {""}
        assert all(r[f"n_{k}"] == sum(s[0] == k for s in spans) for k in kinds)


def test_op6_planted(spark, documents):
    tests = {b["item_id"]: b["text"] for b in pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()}
    squeeze = lambda t: " ".join(re.findall(r"\S+", lower(t)))
    inside = {(d["doc_id"], i) for d in documents for i, t in tests.items() if squeeze(t) in squeeze(d["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in rows(spark, "op6_decontaminate")}
    assert inside <= got
    clean = {d["doc_id"] for d in documents if not any(w in squeeze(d["text"]) for t in tests.values() for w in five(squeeze(t)))}
    assert not clean & {i for i, _ in got}


def five(text):
    w = text.split()
    return [" ".join(w[i : i + 5]) for i in range(len(w) - 4)]


def test_op8_brute_force(spark, documents):
    prints = {}
    for d in documents:
        w = WORD.findall(lower(d["text"]))
        shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[d["doc_id"]] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    ids = sorted(prints)
    component = {i: i for i in ids}
    for a in ids:  # smallest id first, so a walk from it names its component
        if component[a] == a:
            queue = [a]
            while queue:
                x = queue.pop()
                near = [y for y in ids if component[y] == y and y > a and (prints[x] ^ prints[y]).bit_count() <= 2]
                for y in near:
                    component[y] = a
                queue += near
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, "op8_simhash_duplicates")}
    assert got == {i: (f"{prints[i]:016x}", component[i]) for i in ids}


def kept_bytes(texts, length):
    """doc_id -> (bytes, removed, stretches, hash), from (doc_id, text) by id."""
    seen, out = set(), {}
    for i, text in sorted(texts):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if b[s : s + length] in seen:
                gone[s : s + length] = True
            seen.add(b[s : s + length])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_op10_brute_force(spark, documents):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(spark, "op10_remove_repeats")}
    assert got == kept_bytes([(d["doc_id"], d["text"]) for d in documents], 100)


def test_pipeline(spark, documents):
    import corpus_pipeline as pipeline

    docs, kept = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in (kept.get("last") or [d for d in documents])}
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), docs.schema)
        assert docs.columns == pipeline.COLUMNS
        after = {r["doc_id"]: r.asDict() for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "language_id":
            assert len(after) >= 0.98 * len(before)
        if name == "simhash_dedup":
            texts = defaultdict(list)
            for i, r in before.items():
                texts[r["text"]].append(i)
            assert all(len(set(ids) & set(after)) <= 1 for ids in texts.values())
        if name == "decontamination":
            assert len(after) < len(before)
        if name == "pii":
            assert set(after) == set(before)
            for i, r in after.items():
                assert not re.search(BASE["email"][0], r["text"])
                assert r["n_chars"] == len(r["text"])
                if not pii_spans(before[i]["text"]):
                    assert r["text"] == before[i]["text"] or re.search("<(IBAN|SSN)>", r["text"])
        kept["last"] = list(after.values())
    mixed = {r["doc_id"] for r in pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()}
    assert mixed == {r["doc_id"] for r in kept["last"]}
