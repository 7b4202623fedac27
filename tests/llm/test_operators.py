"""Each operator against brute force on a small fixture with nulls, empties, copies, ties, repeated rows and clashing names."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from citespark.llm import katz
from citespark.llm.ann import nearest
from citespark.llm.components import connected_components
from citespark.llm.decontam import Index, find_in, find_leaks
from citespark.llm.grouping import suffix_array
from citespark.llm.katz import K, discounts, score_texts
from citespark.llm.langid import held_out, language_id
from citespark.llm.mixing import mix
from citespark.llm.neardup import drop_near_duplicates
from citespark.llm.pii import find_pii
from citespark.llm.repeats import remove_repeats
from citespark.llm.sharding import shard
from citespark.llm.simhash import simhash_components
from citespark.llm.warc import ZipDirectory, archive_round_trip

random.seed(11)
WORDS = [f"{a}{b}" for a in ("the", "an", "or", "wh", "ti", "sh", "re") for b in ("er", "on", "ing", "ed", "", "éa", "ly")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, fp long, key string, rank int, shard int, `end` long, leaf long"


def _text(n):
    return " ".join(random.choice(WORDS) + str(random.randrange(60)) for _ in range(n))


def _docs():
    base = [_text(n) for n in (1, 2, 3, 5, 30, 60, 90, 120, 150, 40)]
    passage = _text(60)
    texts = [None, "", " \t\n", *base, base[7], base[7].upper(), base[8] + " tail", "x " + base[8], base[5] + " " + passage + " " + base[6], passage, "q" * 700, "aZ é €" * 90, passage[:350] + base[4]]
    texts += [t.replace("er1", "er7", 1) for t in base[6:9]]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3]) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, base[5], "en", "a"), (-4, base[7], "fr", "zz")]
    return rows


ROWS = _docs()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, None, 1, 2, "k", 3, 4, 5, 6) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _collect(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def _fingerprint(t, k=4):
    w = _words(_lower(t))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("block", [4096, 2])
def test_simhash(docs, block):
    prints = [_fingerprint(r[1]) for r in ROWS]
    group = list(range(len(ROWS)))
    for i in range(len(ROWS)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {g: min((r[0] for r, h in zip(ROWS, group) if h == g and r[0] is not None), default=None) for g in group}
    want = sorted(((r[0], f"{p:016x}", least[g]) for r, p, g in zip(ROWS, prints, group)), key=str)
    assert _collect(simhash_components(docs, block=block)) == want


def test_simhash_links_follow_the_bound(spark):
    from citespark.llm.simhash import links

    seeds = [random.getrandbits(63) for _ in range(40)]
    values = seeds + [s ^ sum(1 << b for b in random.sample(range(63), n)) for s in seeds for n in (1, 2, 3, 4, 5)]
    df = spark.createDataFrame([(v,) for v in set(values)], "fp long")

    def closed(pairs):
        up = {v: v for v in values}

        def top(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in pairs:
            up[top(a)] = top(b)
        return {frozenset(v for v in up if top(v) == t) for t in set(map(top, up))}

    for bits in (4, 8):
        true = [(a, b) for a in set(values) for b in set(values) if a < b and (a ^ b).bit_count() <= bits]
        for block in (4096, 3):
            assert closed([(r.a, r.b) for r in links(df, bits, block).collect()]) == closed(true)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (5, 5), (None, 1), (20, 21), (21, 22), (22, 20), *((100, i) for i in range(101, 160)), (159, 22)]
    got = {(r.node, r.root) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {(x, 1) for x in (1, 2, 3, 9)} | {(x, 20) for x in (20, 21, 22, *range(100, 160))}
    assert got == want


@pytest.mark.parametrize("order, split", [(1, 7), (2, 10**9), (2, 7), (3, 10**9), (3, 7), (4, 3)])
def test_katz(docs, order, split):
    """Scores by a plain model of dictionaries, evaluated recursively; its probabilities sum to 1 after every context."""
    learned = [r for r in ROWS if zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 7 != 2]
    tokens = lambda t: [*_words(_lower(t)), "\n"]
    count = [None, *(collections.Counter() for _ in range(order))]
    starts = 0
    for r in learned:
        starts += 1
        padded = ["\t", *tokens(r[1])]
        for i in range(1, len(padded)):
            for n in range(1, min(order, i + 1) + 1):
                count[n][tuple(padded[i - n + 1 : i + 1])] += 1
    n1, v = sum(count[1].values()), len(count[1])
    d = [None, *(discounts([0, *(sum(x == r for x in c.values()) for r in range(1, K + 2))]) for c in count[1:])]
    cut = lambda c, n: c * (d[n][c] if c <= K else 1)
    after = collections.defaultdict(list)
    for n in range(2, order + 1):
        for g in count[n]:
            after[g[:-1]].append(g[-1])
    times = lambda h: starts if h == ("\t",) else count[len(h)][h]
    memo = {}

    def size(h):
        n = len(h) + 1
        seen = [count[n][*h, w] for w in after[h]]
        return times(h) + (0 if any(cut(c, n) != c for c in seen) else 0.5)

    unknown = 1 - sum(cut(c, 1) / n1 for c in count[1].values())

    def weight(h):
        if h not in memo:
            n = len(h) + 1
            memo[h] = (1 - sum(cut(count[n][*h, w], n) for w in after[h]) / size(h)) / (1 - sum(p(w, h[1:]) for w in after[h]))
        return memo[h]

    def p(w, h):
        if not h:
            return cut(count[1][w,], 1) / n1 if count[1][w,] else unknown
        if not after[h]:
            return p(w, h[1:])
        c = count[len(h) + 1][*h, w]
        return cut(c, len(h) + 1) / size(h) if c else weight(h) * p(w, h[1:])

    for h in random.sample(sorted(after), min(len(after), 40)):
        if after[h]:
            assert abs(sum(p(w, h) for w, in count[1]) + p("never seen", h) - 1) < 1e-9
    got = collections.defaultdict(list)
    for r in score_texts(docs, held_out(7, 2), order=order, chunk_tokens=300, bucket_bytes=2000, split=split).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(ROWS)
    for doc_id, text, *_ in ROWS:
        t = tokens(text)
        padded = ["\t", *t]
        score = sum(math.log10(p(padded[i], tuple(padded[max(0, i - order + 1) : i]))) for i in range(1, len(padded)))
        base = sum(math.log10((count[1][w,] + 1) / (n1 + v + 1)) for w in t)
        r = got[doc_id].pop()
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(count[1][w,] > 0 for w in t), n1)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_katz_replies(docs, monkeypatch):
    """Replies tell what weights are made of for contexts before n-grams never seen alone: at most one for each such n-gram."""
    seen, drop = [], katz.forget
    monkeypatch.setattr(katz, "forget", lambda t: (seen.extend(katz._unpack(bytes(r.blob)) for r in t.where("kind rlike '^n[2-9]'").collect()), drop(t)))
    score_texts(docs, held_out(7, 2), chunk_tokens=300, bucket_bytes=2000).count()
    never = [int((b[0] == 0).sum()) for b in seen]
    assert any(never) and not all(never)
    assert all(len(x) <= n for n, b in zip(never, seen) for x in b[-katz._SUMS :])


def test_language(spark, empty, sf):
    rows = language_id(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    judged = [r for r in rows if r.held_out]
    assert len(judged) > 30 and sum(r.lang == r.lang_pred for r in judged) / len(judged) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    odd = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "12 34 !", "fr"), (4, "hello there", "en"), (4, "hello there", "en"), (9, "bonjour", "fr")], "doc_id long, text string, lang string")
    got = _collect(language_id(odd).select("doc_id", "lang_pred"))
    assert [g for g in got if g[0] < 4] == [(1, "und"), (2, "und"), (3, "und")] and len(got) == 6


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[200:700] = x[100]  # a hot vector
    rows = [(i, v.tolist(), 7) for i, v in enumerate(x)]
    odd = [(1500, None, 0), (1550, [0.0] * 16, 0), (1600, [float("nan")] * 16, 0), (1650, [None] * 16, 0), (1700, [1.0] * 3, 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, leaf long")
    got = collections.defaultdict(list)
    for r in nearest(df, sample=600, leaf_size=40, leaf_rows=50).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 1500, 50))
    d = x.astype(np.float64)
    norm = np.sqrt((d * d).sum(1))
    hit = 0
    for q, found in got.items():
        s = (d * d[q]).sum(1) / (norm * norm[q])
        s[q] = -9
        best = np.lexsort((np.arange(len(s)), -s))[:5]
        found.sort()
        assert [f[0] for f in found] == [1, 2, 3, 4, 5] and all(abs(s[f[1]] - f[2]) < 1e-12 for f in found)
        hit += len({f[1] for f in found} & set(best.tolist()))
    assert hit / (5 * len(got)) >= 0.9
    assert nearest(df.where("vec_id in (0, 7)")).count() == 1  # fewer candidates than k


def test_leaks(spark):
    items = [(k, _text(n)) for k, n in enumerate((30, 40, 12, 80))] + [(9, None), (10, ""), (11, "the"), (0, None)]
    index = Index([(k, t) for k, t in items if t])
    texts, want = [None, "", _text(300)], [set(), set(), set()]
    for k, t in items[:4]:
        near = list(t)
        for _ in range(len(t) // 15):
            i = random.randrange(len(near))
            near[i] = random.choice(["", "zz", near[i] + "y", "w"])
        for v in (t, t.upper().replace(" ", ",  "), "".join(near)):
            a = _text(random.randrange(0, 80))
            texts.append(f"{a} {v} {_text(20)}")
            want.append({k})
    found = find_in(texts, index)
    assert [{m[0] for m in f} for f in found] == want
    for t, f, (k, item) in zip(texts[3::3], found[3::3], items):
        start, end, edits = f[0][1:]
        assert edits == 0 and t[start:end].strip() == item.strip()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, leaks string, start int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (10**6, 150):  # one index, or several passes
        assert {(r.doc_id, r.item_id) for r in find_leaks(df, bench, limit=limit).collect()} == {(i, k) for i, w in enumerate(want) for k in w}


def test_suffix_array():
    for _ in range(1500):
        t = [random.randrange(random.choice((1, 2, 3, 9))) for _ in range(random.randrange(30))]
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("hot, block, chunk", [(20_000, 100_000, 1 << 20), (1, 50, 1500)])
def test_repeats(docs, hot, block, chunk):
    data = [(r[1] or "").encode() for r in ROWS]
    count = collections.Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    want = []
    for r, d in zip(ROWS, data):
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - 199):
            if count[d[i : i + 200]] > 1:
                gone[i : i + 200] = True
        gone = gone[: len(d)]
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        want.append((r[0], len(d), int(gone.sum()), spans, hashlib.sha256(bytes(c for c, g in zip(d, gone) if not g)).hexdigest()))
    got = remove_repeats(docs, chunk_bytes=chunk, bucket_bytes=3000, block=block, hot=hot)
    assert _collect(got) == sorted(want, key=str)


@pytest.mark.parametrize("shards, summary", [(4, 65_536), (3, 4), (16, 8)])
def test_shards(docs, shards, summary):
    """Every row as by a plain minimax partition of the groups in md5 order."""
    group = lambda t: "null" if t is None else hashlib.md5(t.encode()).hexdigest()
    size = lambda t: len((t or "").encode()) + 1
    sums = collections.Counter()
    for r in ROWS:
        sums[group(r[1])] += size(r[1])
    order = sorted(sums)

    def cut(capacity):
        out, at, load = {}, 0, 0
        for g in order:
            if load and load + sums[g] > capacity:
                at, load = at + 1, 0
            out[g], load = at, load + sums[g]
        return out, at + 1

    capacity = next(c for c in range(1, sum(sums.values()) + 1) if cut(c)[1] <= shards)  # a group above it stands alone
    want = cut(capacity)[0]
    got = [r.asDict() for r in shard(docs, shards, summary).collect()]
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in got), key=str) == sorted(((r[0], size(r[1]), zlib.crc32((r[1] or "").encode()), want[group(r[1])]) for r in ROWS), key=str)
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_minimax(spark):
    from citespark.llm.sharding import minimax_cuts

    def brute(sizes, m):
        best = {0: [0] + [10**9] * len(sizes)}
        for k in range(1, m + 1):
            best[k] = [0] + [min(max(best[k - 1][j], sum(sizes[j:i])) for j in range(i + 1)) for i in range(1, len(sizes) + 1)]
        return best[m][-1]

    for n, m, summary in ((40, 5, 8), (25, 3, 65_536), (60, 16, 20), (3, 8, 4)):
        sizes = [random.randrange(1, 60) for _ in range(n)]
        ends = np.cumsum(sizes).tolist()
        cuts = minimax_cuts(spark.createDataFrame([(e,) for e in ends], "`end` long"), ends[-1], max(sizes), m, summary)
        assert cuts[-1] == ends[-1] and all(c in ends for c in cuts)
        assert max(b - a for a, b in zip([0, *cuts], cuts)) == brute(sizes, m)


def test_archives(spark, tmp_path):
    body = "<p>" + "é" * 80
    rows = [(1, "http://a/\r\nX: y", body), (2, None, body), (2, None, body), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", body), (9, "v", "z" * 300)]
    df = spark.createDataFrame([(*r, "d", 5) for r in rows], "page_id long, url string, html string, digest string, first long")
    want = []
    for p, _, h in rows:
        data = (h or "").encode()
        again = p is not None and len(data) >= 100 and p > min(q for q, _, x in rows if x == h and q is not None)
        want.append((p, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 1 if again else None))
    got = archive_round_trip(spark, df, f"file://{tmp_path}/archives-t")
    assert _collect(got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == sorted(want, key=str)


def test_zip64(tmp_path):
    import io
    import zipfile

    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        with z.open(zipfile.ZipInfo("big"), "w", force_zip64=True) as f:
            f.write(b"hello")
        for i in range(70_000):
            z.writestr(f"n{i}", b"")
        z.comment = b"note PK\5\6"
    data = raw.getvalue()
    d = ZipDirectory(lambda at, n: data[at : at + n], len(data))
    at, n = d.stored("big")
    assert len(d.members) == 70_001 and data[at : at + n] == b"hello"
    with pytest.raises(ValueError):
        ZipDirectory(lambda at, n: data[: len(data) // 2][at : at + n], len(data) // 2)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def _base(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 14 <= len(digits) <= 19 and _luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, kind, m.end()))
    return sorted(out)


def test_pii(spark):
    texts = [
        None, "", "a@b.c@d.e x@b.com+foo@d.e", "mail😀 é me.x@mail.example.com.", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255 1.2.3", "card 4111 1111 1111 1111 4111-1111-1111-1112",
        "+1 (743) 555-3824, +12 +1.2.3.4.5.6.7.8.9.0 ++44 20 7946 0958 0", "call 743-555-3824 or 743-555-3824", "iban GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33",
        "ssn 123-45-6789 vs 123-45-6789", "a" * 900 + "@", "1" * 900, "1.1." * 300, " ".join(f"u{i}@h.org" for i in range(700)), "@.@ x@y 0@0.0", "--@-.-",
    ]
    texts += ["".join(random.choice("a1@.+- 4(\n") for _ in range(300)) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "q", 5) for i, t in enumerate(texts)] + [(5, texts[5], "q", 5)], "doc_id long, text string, gaps string, found int")
    rows = find_pii(df).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        spans = _base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in spans).encode()).hexdigest(), texts[r.doc_id][:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in spans) for k in BASE]
    # texts of a size at which a pattern that tries every start would not end
    long = spark.createDataFrame([(0, "a" * 200_000 + "@"), (1, "1" * 200_000), (2, "1.1." * 3_000)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_email, r.n_ip, r.n_card) for r in find_pii(long).collect()) == [(0, 0, 0, 0), (1, 0, 0, 0), (2, 0, 1500, 0)]
    by = {r.doc_id: r.spans for r in rows}
    assert "iban:5:32" in by[8] and by[8].count("iban") == 1 and by[9].startswith("nid:4:15") and by[7].startswith("tel:5:17")


def test_iban_ends_by_its_length(spark):
    texts = ["IBAN BE68 5390 0754 7034 BIC GEBABEBB", "AT61 1904 3002 3457 3201 PAID", "ES9121000418450200051332 1", "DE89 3704 0044 0532 0130 00 EUR", "BE68 5390 0754 7035 BIC", "ZZ82 WEST 1234 5698 7654 32"]
    got = {r.doc_id: r.spans for r in find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [[s for s in got[i].split(",") if s.startswith("iban")] for i in range(6)] == [["iban:5:24"], ["iban:0:24"], ["iban:0:24"], ["iban:0:27"], [], []]


def test_mix(docs):
    got = [r.asDict() for r in mix(docs).collect()]
    assert len(got) == len(ROWS)
    size = collections.Counter()
    for r in ROWS:
        size[r[3]] += len(_words(r[1]))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = sum(size.values()), {}, set(names)
    while True:
        share = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * share > 3 * size[s]}
        target |= {s: 3 * size[s] for s in over}
        if not over:
            break
        open_ -= over
    target |= {s: weight[s] * share for s in open_}
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(target[r["source"]]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == math.floor(target[s] + 0.5) for s in names)
    assert _collect(mix(docs)) == _collect(mix(docs.repartition(3)))


def shingle_set(text, n):
    w = _words(_lower(text))
    return {" ".join(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))}


@pytest.mark.parametrize("texts", [2048, 2])
def test_near_duplicates(docs, texts):
    kept = {(r.doc_id, r.text or "") for r in drop_near_duplicates(docs, group_texts=texts).collect()}
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in ROWS}, key=lambda r: r[:2])
    sets, want, seen = [], set(), set()
    for none, doc_id, text in order:
        own = shingle_set(text, 5)
        if text not in seen and not any(len(own & s) / len(own | s) >= 0.8 for s in sets):
            want.add((None if none else doc_id, text))
            sets.append(own)
        seen.add(text)
    assert kept == want
    assert drop_near_duplicates(docs, group_texts=texts).count() == len(want)


def test_empty_tables(spark, empty):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    items = spark.createDataFrame([], "item_id long, text string")
    results = [
        simhash_components(empty), score_texts(empty, held_out(7, 2)), language_id(empty), nearest(vectors), find_leaks(empty, items), remove_repeats(empty),
        shard(empty), archive_round_trip(spark, pages), find_pii(empty), mix(empty), drop_near_duplicates(empty),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_one_value_everywhere(spark):
    """All rows null, and all rows equal."""
    for text in (None, "same words in every text of this table"):
        df = spark.createDataFrame([(i % 3 if i else None, text, None, None) for i in range(9)], "doc_id long, text string, lang string, source string")
        assert {r.component_id for r in simhash_components(df).collect()} == {0}
        assert drop_near_duplicates(df).count() == 1
        for out in (score_texts(df, held_out(7, 2)), language_id(df), remove_repeats(df), shard(df), find_pii(df), mix(df)):
            assert out.count() == 9


def test_language_reads_whole_runs(spark):
    """A letter run counts to its end: two runs with the same head go by what follows it."""
    from citespark.llm import langid

    rows = [(i, "abcd abdc acbd " * 9, "aa") for i in range(4)] + [(i, "wxyz wyxz wzxy " * 9, "zz") for i in range(4, 8)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    head = "abcdabdc" * 8
    assert model.predict(head)[0] == "aa"
    for tail in ("wxyzwyxz" * 20, "wxyzwyxz" * 2000, "wxyzwyxz" * 400_000):  # one part, several, more than one piece
        assert model.predict(head + tail)[0] == "zz"
    mean = lambda w: np.mean([model.rows[model.grams[4][g]] for g in langid._grams(w, 4) if g in model.grams[4]], axis=0)
    for word in ("wxyzwyxz" * 3, "abcdwxyz" * 3001):
        assert model.backoff(word)[0] == pytest.approx(mean(word))
    pieces = list(langid._pieces("a" * (5 << 19) + " b", 3))
    assert [len(p) for p in pieces] == [2 << 20, (1 << 19) + 5] and "".join(pieces).count("b") == 1


def test_leaks_at_every_offset():
    """Passages of 100 to 148 bytes from any offset of an item, whole or with edits, are found."""
    rng = random.Random(3)
    text = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    item = text(70)
    index = Index([(1, item)])
    cases = []
    for at in range(7, len(item) - 150, 33):
        for size in (100, 110, 120, 148):
            part = item[at : at + size]
            cases.append(part)
            near = list(part)
            for i in rng.sample(range(len(near)), 5):
                near[i] = "#9"[rng.randrange(2)] if near[i] != " " else "q"
            cases.append("".join(near))
    texts = [f"{text(12)} {c} {text(12)}" for c in cases]
    found = find_in(texts, index)
    assert [len(f) for f in found] == [1] * len(texts)
    assert all(f[0][3] == 0 for f in found[::2]) and all(f[0][3] <= 10 for f in found)
    assert not any(find_in([f"{text(12)} {item[a : a + 70]} {text(12)}" for a in range(0, 200, 7)], index))


def test_near_duplicates_meet(spark):
    """Of pairs of similarity 0.80 to 0.90 one goes, judged by brute force; of pairs below 0.8 none."""
    rng = random.Random(9)
    rows, alike = [], {}
    while len(alike) < 400:
        words = [str(rng.randrange(10**6)) for _ in range(200)]
        near = list(words)
        for i in rng.sample(range(200), rng.randrange(2, 7)):
            near[i] = "x" + near[i]
        x, y = shingle_set(" ".join(words), 5), shingle_set(" ".join(near), 5)
        share = len(x & y) / len(x | y)
        if 0.7 <= share < 0.9:
            k = 2 * len(alike)
            alike[k] = share
            rows += [(k, " ".join(words), 1, 2), (k + 1, " ".join(near), 1, 2)]
    left = {r.doc_id for r in drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, digest int, root int")).collect()}
    assert left >= set(alike)
    met = {}
    for k, share in alike.items():
        met.setdefault(int(share * 50) / 50, []).append(k + 1 not in left)
    print({k: (sum(v), len(v)) for k, v in sorted(met.items())})
    assert all(sum(v) >= 0.96 * len(v) if k >= 0.8 else not any(v) for k, v in met.items())


def test_shingle_hashes_and_codes():
    """One hash for each distinct shingle, whatever the part borders; codes by plain counting."""
    from citespark.llm import shingles

    texts = [r[1] for r in ROWS] + [" ".join(WORDS) + "\n" + "é " * 700, "A b C d e F g", "a B c D e f G"]
    keep = shingles.PART, shingles.SLICE
    try:
        for part, slice_ in ((1 << 20, 1 << 16), (64, 300)):
            shingles.PART, shingles.SLICE = part, slice_
            sets = shingles.shingle_hashes(texts, 5)
            name = {}
            for t, s in zip(texts, sets):
                assert len(s) == len(shingle_set(t, 5))
                assert name.setdefault(frozenset(s.tolist()), frozenset(shingle_set(t, 5))) == frozenset(shingle_set(t, 5))
            got = shingles.codes(sets, 2)
            tie = np.unpackbits(shingles._mix(np.arange(1, 3, dtype=np.uint64) * np.uint64(shingles._ODD)).view(np.uint8), bitorder="little")
            for s, code in zip(sets, got):
                for w in range(2):
                    derived = shingles._mix(s ^ np.uint64((w + 1) * 0xC2B2AE3D27D4EB4F & (2**64 - 1))).tolist()
                    for b in range(64):
                        n = sum(x >> b & 1 for x in derived)
                        assert int(code[w]) >> b & 1 == (2 * n + int(tie[64 * w + b]) > len(s))
    finally:
        shingles.PART, shingles.SLICE = keep


def _leaks_by_brute_force(texts, items):
    """(doc, item): fewest edits of any window of an item, by a plain alignment of every window with every text."""
    def normal(t):
        return re.sub(rb" +", b" ", bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in (t or "").encode().lower())).strip()

    out = {}
    for d, text in enumerate(texts):
        data = np.frombuffer(normal(text), np.uint8)
        for item, passage in items:
            p = np.frombuffer(normal(passage), np.uint8)
            if len(p) < 8 or not len(data):
                continue
            m = min(len(p), 100)
            budget = min(m // 10, (m - 8) // 8)
            windows = np.stack([p[i : i + m] for i in range(len(p) - m + 1)])
            rows = np.repeat(np.arange(m + 1)[None, :], len(windows), 0)  # edits of each prefix, text ends anywhere
            best = rows[:, m].copy()
            for c in data:
                new = np.zeros_like(rows)
                for i in range(1, m + 1):
                    new[:, i] = np.minimum(np.minimum(rows[:, i - 1] + (windows[:, i - 1] != c), rows[:, i] + 1), new[:, i - 1] + 1)
                rows = new
                best = np.minimum(best, rows[:, m])
            if best.min() <= budget:
                out[d, item] = min(out.get((d, item), 99), int(best.min()))
    return out


@pytest.mark.parametrize("hits", [1 << 21, 100])
def test_leaks_by_brute_force(spark, monkeypatch, hits):
    """Rows and edits as by plain alignment, whatever the number of indexes and the parts that texts are scanned in."""
    from citespark.llm import decontam

    monkeypatch.setattr(decontam, "HITS", hits)
    rng = random.Random(8)
    letters = "abcd"
    text = lambda n: " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(n))
    items = [(1, text(30)), (1, text(34)), (2, text(9)), (3, text(40)), (4, "ab")]
    texts = [None, "", "a"]
    for _, passage in items[:4]:
        for n in (0, 4, 9, 12, 16):
            near = list(passage[rng.randrange(20) :] if n % 2 else passage)
            for i in rng.sample(range(len(near)), min(n, len(near))):
                near[i] = rng.choice(["", "x", near[i] + "y"])
            texts.append(f"{text(rng.randrange(8))} {''.join(near)} {text(rng.randrange(8))}")
    texts.append(f"{items[0][1]} {items[1][1]}")  # both texts of one item
    want = _leaks_by_brute_force(texts, items)
    assert len(want) > 8
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, None)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    first = None
    for limit in (10**6, 100, 30):
        got = sorted(map(tuple, find_leaks(df, bench, limit=limit).collect()))
        assert {(d, i): x for d, i, _, _, x in got} == want and len(got) == len(want)
        first = first or got
        assert got == first


def test_leaks_in_odd_letters_and_across_parts(monkeypatch):
    """Case folds letter by letter, so one letter without a fold of its length changes nothing else; passages at any border of parts are found."""
    from citespark.llm import decontam

    rng = random.Random(4)
    passage = " ".join("".join(rng.choice("abcdeéñü") for _ in range(rng.randrange(3, 8))) for _ in range(25))
    index = Index([(1, passage)])
    for tail in ("", "İ", " ẞ K Σ"):
        assert len(find_in([passage.upper().replace("Σ", "σ") + tail], index)[0]) == 1
    monkeypatch.setattr(decontam, "CHUNK", 700)
    fill = "z" * 30 + " "
    for before in range(0, 90, 3):
        text = fill * before + passage + " " + fill * 30
        (found,) = find_in([text], index)
        assert len(found) == 1 and text[found[0][1] : found[0][2]].strip() == passage


def test_language_by_brute_force(spark, monkeypatch):
    """Predictions, scores and evidence by plain dictionaries, on every language there is, whatever the pieces."""
    from citespark.llm import langid

    monkeypatch.setattr(langid, "_PIECE", 50)
    rng = random.Random(6)
    langs = [f"l{k:02d}" for k in range(70)]
    rows = []
    for k, lang in enumerate(langs):
        own = [chr(97 + (k + j * j) % 26) for j in range(7)]
        for _ in range(6):
            words = ["".join(rng.choice(own) for _ in range(rng.randrange(2, 7))) for _ in range(rng.randrange(1, 30))]
            rows.append((len(rows), rng.choice((" ", "\n", "\t", "-")).join(words), lang))
    rows += [(len(rows), None, "l01"), (len(rows) + 1, "12 !", "l01"), (None, rows[3][1], "l00"), rows[5], (len(rows) + 2, rows[9][1], None)]
    learned = {(r[1], r[2]) for r in rows if r[1] and r[2] and zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 3 != 1}
    names = sorted({x for _, x in learned})
    letters = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    count = {n: collections.Counter() for n in range(5)}
    for t, lang in learned:
        for w in letters(t):
            count[0][lang, w] += 1
            for n in (1, 2, 3, 4):
                count[n].update((lang, f"<{w}>"[i : i + n]) for i in range(len(w) + 3 - n))
    total = {n: collections.Counter() for n in count}
    keys = {n: {g for _, g in c} for n, c in count.items()}
    for n, c in count.items():
        for (lang, _), x in c.items():
            total[n][lang] += x
    logp = lambda n, lang, g: math.log((count[n][lang, g] + 0.5) / ((total[n][lang] if count[n][lang, g] else max(total[n].values())) + 1))

    def score(t):
        sums = dict.fromkeys(names, 0.0)
        for w in letters(t):
            if w in keys[0]:
                for lang in names:
                    sums[lang] += logp(0, lang, w)
                continue
            for n in (4, 3, 2, 1):
                known = [g for i in range(len(w) + 3 - n) if (g := f"<{w}>"[i : i + n]) in keys[n]]
                if known:
                    for lang in names:
                        sums[lang] += sum(logp(n, lang, g) for g in known) / len(known)
                    break
        best = max(sums.values())
        return {x for x in names if sums[x] > best - 1e-9}, 1 / sum(math.exp(s - best) for s in sums.values())

    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, found int")
    got = language_id(df).collect()
    assert len(got) == len(rows)
    by = {r[0]: r[1] for r in rows}
    for r in got:
        want = score(by[r.doc_id]) if letters(by[r.doc_id]) else ({"und"}, 0.0)
        assert r.score == pytest.approx(want[1], abs=1e-9)
        assert r.lang_pred in want[0]
    assert len({r.lang_pred for r in got} & set(names)) > 64
