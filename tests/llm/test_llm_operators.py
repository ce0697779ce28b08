"""Operators of sessionlab.llm against brute force on small fixtures."""
import base64
import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001
from sessionlab.llm import ann, common, decontam, html, langid, packing, quality, simhash, spelling, substring, topk, toxicity, trie, warc
from sessionlab.llm.queries import ORACLE, QUERIES, tokenizer_path

DOC = "doc_id long, text string, k string, score string, fp int"


def docs_df(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOC)


EDGE = [(1, None), (2, ""), (3, "   \n\t"), (4, "a"), (None, "no id"), (5, "word " * 20000), (6, "same text here"),
        (7, "same text here"), (7, "same text here"), (8, "Ünïcödé ß 漢字 \x00 end"), (9, "12345 !!! ---")]


# ------------------------------------------------------------------ WARC

def test_warc_round_trip(spark, tmp_out):
    rows = [(1, "http://a", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u", None), (4, "u", ""), (None, "n", "<p>x</p>"),
            (5, "big", "é" * 300000), (6, "u", "only"), (6, "u", "only")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, k string")
    folder = f"file://{tmp_out}/warc"
    index = warc.write_bundles(pages, folder, frame_bytes=64, bundle_frames=3)
    got = warc.read_bundles(index, folder).collect()
    assert len(got) == len(rows)
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    for r in got:
        h = next((h or "") for i, _, h in rows if i == r.page_id)
        own = -1 if r.page_id is None else r.page_id
        assert r.payload_bytes == len(h.encode())
        assert r.payload_digest == base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        assert r.record_type == ("response" if own == top[h] else "revisit")
        assert r.refers_to == (None if own == top[h] else top[h])
    at = index.where("page_id = 5").first()
    headers, payload = warc.read_record(folder, at.bundle, at.frame, at.offset)
    assert payload.decode() == "é" * 300000 and headers["WARC-Target-URI"] == "big"
    assert warc.read_bundles(warc.write_bundles(pages.limit(0), folder), folder).count() == 0
    small = warc.read_bundles(warc.write_bundles(pages, folder, min_bytes=1), folder)
    assert small.where("payload_bytes = 0 and record_type = 'revisit'").count() == 0


# --------------------------------------------------------------- packing

def test_packing_covers_every_id(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    rows = EDGE + [(i, " ".join(f"Word{j}, it's" for j in range(i * 7))) for i in range(20, 60)]
    out = packing.pack(docs_df(spark, rows), tokenizer_path()).collect()
    want = collections.Counter()
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want[(i, ids.tobytes())] += 1
    pieces = collections.defaultdict(list)
    for r in out:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces[r.doc_id].append(r)
    for i in {i for i, _ in rows}:
        whole = collections.Counter()
        parts = sorted(pieces[i], key=lambda r: r.start)
        for (d, ids), n in want.items():
            if d == i:
                whole[ids] += n
        rebuilt = b"".join(r.ids for r in parts if True) if sum(whole.values()) == 1 else None
        if rebuilt is not None:
            assert rebuilt == next(iter(whole))
        assert sum(r.length for r in parts) == sum(len(x) // 4 * n for x, n in whole.items())
    by = collections.defaultdict(list)
    for r in out:
        by[r.sequence_id].append(r)
    for w in by.values():
        w.sort(key=lambda r: r.offset)
        at = 0
        for r in w:
            assert r.offset == at
            at += r.length
        assert at == 2048 or at & (at - 1) == 0
    assert packing.pack(docs_df(spark, rows).limit(0), tokenizer_path()).count() == 0


def test_sum_of_squares_level():
    p = packing.SumOfSquares(8)
    rng = random.Random(3)
    for _ in range(300):
        size = rng.randint(1, 7)
        n = p.count.copy()

        def total(h):
            m = n.copy()
            if h:
                m[h] -= 1
            if h + size < 8:
                m[h + size] += 1
            return int((m[1:8] ** 2).sum())

        options = [0] + [h for h in range(1, 8) if n[h] and h + size <= 8]
        assert total(p.level_for(size)) == min(map(total, options))
        p.place((0, 0, size, np.zeros(size, "<u4"), size))


@pytest.mark.parametrize("text", ["a<|endoftext|>b c", " x", "é b\x1cc\td 's it's", "ÀÉ ﬁ Σας ΟΔΟΣ İstanbul", "it's,, we'll.",
                                  "Abc... DEF$$ x" * 10, "a" * 200, "ä̈ ö"])
def test_chunk_encoder_equals_tokenizer(text):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    enc = packing.ChunkEncoder(tok)
    for _ in range(2):
        assert enc([text, "the"])[0] == np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


# ----------------------------------------------------------- classifiers

def test_toxicity_learns_gapped_insults(spark):
    rng = random.Random(5)
    syl = ["on", "er", "the", "tion", "and", "ing", "re", "ha", "st"]
    word = lambda: "".join(rng.choice(syl) for _ in range(rng.randint(1, 3)))
    rows, labels = [], []
    for i in range(400):
        w = [word() for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                w[rng.randrange(60)] = rng.choice(["idiot", "scumbag", "moronic"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad), "en"))
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    model = toxicity.fit(docs_df(spark, rows), lab.where("doc_id < 300"))
    test = rows[300:] + [(1000, "the on i.d.i*o_t reon"), (1001, "reon id-iot ing"), (1002, "then s c u m b a g ha")] + EDGE
    got = {(r.doc_id): r for r in toxicity.predict(docs_df(spark, test), model).collect()}
    assert all(got[i].predicted == (i % 4 == 0) for i in range(300, 400))
    assert got[1000].predicted == got[1001].predicted == got[1002].predicted == 1
    assert got[1].predicted == 0 and all(0 <= r.score <= 1 and r.score == r.score for r in got.values())
    assert toxicity.fit(docs_df(spark, rows), lab.limit(0)) is None
    assert {r.score for r in toxicity.predict(docs_df(spark, test), None).collect()} == {0.0}


def test_subsequence_kernel_is_the_explicit_sum():
    a, b = b"\x01idiot", b"\x01idxiot"
    begin, slots, values = toxicity._sparse([a, b])
    k = collections.defaultdict(float)

    def features(w):
        out = collections.Counter()
        for off in toxicity._OFFSETS:
            for i in range(len(w) - off[-1]):
                out[bytes([w[i], *(w[i + o] for o in off)])] += toxicity.DECAY ** (off[-1] + 1)
        return out

    fa, fb = features(a), features(b)
    norm = [toxicity._norms(np.array([len(w)]))[0] for w in (a, b)]
    want = sum(v * fb[x] for x, v in fa.items()) / norm[0] / norm[1]
    for j, s in zip(slots[:begin[1]], values[:begin[1]]):
        k[j] += s
    got = sum(k[j] * s for j, s in zip(slots[begin[1]:], values[begin[1]:]) if j in k)
    assert math.isclose(got, want, rel_tol=1e-5)


def test_language_id(spark):
    base = {"en": "the and with from house street", "de": "der und mit aus haus straße", "fr": "le et avec de maison où"}
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(base[lg].split()) for _ in range(12)), lg) for i in range(150)
            for lg in [sorted(base)[i % 3]]]
    df = spark.createDataFrame([(*r, "x") for r in rows] + [(900, None, "en", "x"), (901, "text", None, "x")],
                               "doc_id long, text string, lang string, k string")
    model = langid.fit(df.where("doc_id < 100"))
    got = {r.doc_id: r for r in langid.predict(docs_df(spark, [(i, t) for i, t, _ in rows] + [(2000 + i, t) for i, (_, t) in enumerate(EDGE)]), model).collect()}
    assert all(got[i].lang_pred == lg for i, _, lg in rows)
    und = [got[2000 + i].lang_pred == "und" for i in range(len(EDGE))]
    assert und == [not any(c.isalpha() for c in (t or "")) for _, t in EDGE]
    kept = langid.determined(docs_df(spark, EDGE), model)
    assert kept.columns == ["doc_id", "text", "k", "score", "fp"] and kept.count() == und.count(False)
    assert langid.fit(df.limit(0)) is None
    assert langid.predict(docs_df(spark, EDGE), None).where("lang_pred <> 'und'").count() == 0


def test_presence_is_the_set_of_grams():
    texts = ["Abc ab", "", "é1x"]
    raw, at = common.utf8(pa.array(texts))
    x = langid.presence(raw, at)
    assert x[1].sum() == 0
    assert (langid.presence(*common.utf8(pa.array(["abc ab"])))[0] == x[0]).all()
    assert x[0].sum() == len({g for n in (1, 2, 3) for g in ("abc ab"[i:i + n] for i in range(7 - n))})


def test_quality_positive_unlabelled(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        good = i % 4 != 0
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(50)]
        if not good:
            w = [x.upper() + "$$#" for x in w] if i % 8 else w[:2] * 25
        rows.append((i, " ".join(w)))
        labels.append((i, int(good)))
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    df = docs_df(spark, rows)
    model = quality.fit(df, lab.where("doc_id < 450"), df)
    assert 0.5 < model.prior < 0.95
    got = {r.doc_id: r for r in quality.predict(docs_df(spark, rows[450:] + [(5000 + i, t) for i, (_, t) in enumerate(EDGE)]), model).collect()}
    assert sum(got[i].predicted == (i % 4 != 0) for i in range(450, 600)) >= 145
    assert all(0 <= r.score <= 1 for r in got.values())
    assert quality.fit(df, lab.limit(0), df) is None
    assert {r.predicted for r in quality.predict(df, None).collect()} == {0}


# --------------------------------------------------------------- simhash

def brute_fingerprint(text):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
         .replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in ([w[i:i + 3] for i in range(len(w) - 2)] or [w])]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius):
    n, root = len(fps), list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= radius:
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(n):
        groups[find(i)].append(fps[i][0])
    return {tuple(sorted(g)): min(g) for g in groups.values()}


def test_simhash_near_dedup(spark):
    got = simhash.near_dedup(docs_df(spark, EDGE + [(50, "A B c d"), (51, "x\x0by\x0cz w v")])).collect()
    assert len(got) == len(EDGE) + 2
    for r in got:
        t = next(t for i, t in EDGE + [(50, "A B c d"), (51, "x\x0by\x0cz w v")] if i == r.doc_id)
        assert r.fingerprint == f"{brute_fingerprint(t):016x}"
    assert {r.doc_id: r.component_id for r in got}[7] == 6
    kept = simhash.representatives(docs_df(spark, EDGE))
    assert kept.columns == ["doc_id", "text", "k", "score", "fp"]
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 4, 5, 6, 8, 9]
    assert simhash.near_dedup(docs_df(spark, EDGE).limit(0)).count() == 0


def test_representatives_of_unnumbered_and_shared_ids(spark):
    """Classes without an id, and classes that share their smallest id, each
    keep a document."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 9) for _ in range(60)) for _ in range(9)]
    rows = [(None, t) for t in texts[:5]] + [(None, texts[0]), (3, texts[5]), (3, texts[6]), (4, texts[5]), (4, texts[7]),
                                             (5, texts[7]), (None, texts[8]), (6, texts[8]), (6, texts[8])]
    assert len(set(brute_components([(t, brute_fingerprint(t)) for t in texts], 2).values())) == len(texts)
    kept = [(r.doc_id, r.text) for r in simhash.representatives(docs_df(spark, rows)).collect()]
    assert sorted(kept, key=str) == sorted([(None, t) for t in texts[:5]] + [
        (3, texts[5]), (3, texts[6]), (4, texts[7]), (6, texts[8])], key=str)


@pytest.mark.parametrize("tile", [4, 1024])
def test_links_are_exact(spark, tile):
    rng = random.Random(tile)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = set(base)
    for b in base:
        x = b
        for _ in range(25):
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    comp = simhash.components(simhash.links(df, 2, tile)).collect()
    root = {r.node: r.root for r in comp}
    groups = collections.defaultdict(list)
    for x in signed:
        groups[root.get(x, x)].append(x)
    assert {tuple(sorted(g)) for g in groups.values()} == set(brute_components(list(zip(signed, fps)), 2))


def test_components_of_a_long_chain(spark):
    n = 60
    got = simhash.components(spark.createDataFrame([(i, i + 1) for i in range(n)], "u long, v long")).collect()
    assert {r.node: r.root for r in got} == {i: 0 for i in range(1, n + 1)}
    assert simhash.components(spark.createDataFrame([], "u long, v long")).count() == 0


# ------------------------------------------------------------- substrings

def brute_removed(rows, length):
    seen, out = set(), {}
    for k, t in rows:
        cover, dup = [False] * len(t), []
        for p in range(len(t) - length + 1):
            s = t[p:p + length]
            if s in seen:
                dup.append(p)
            seen.add(s)
        for p in dup:
            cover[p:p + length] = [True] * length
        out[k] = cover
    return out


def test_shards_against_brute_force():
    rng = random.Random(1)
    for trial in range(120):
        length, gram = rng.choice([6, 10, 17]), rng.choice([3, 4, 5])
        letters = rng.choice([b"ab", b"abcd", b"a", bytes(range(97, 117)), b"\x00a"])
        texts = []
        for _ in range(rng.randint(1, 8)):
            t = bytes(rng.choice(letters) for _ in range(rng.randint(0, 60)))
            if texts and rng.random() < .5:
                b = rng.choice(texts)
                a = rng.randint(0, len(b))
                t += b[a:a + rng.randint(0, 50)] + t[:5]
            texts.append(t)
        raw = np.frombuffer(b"".join(texts), np.uint8)
        _, d, lo, n = substring.stretches(raw, np.cumsum([0] + [len(t) for t in texts]), length, gram)
        ctx = [texts[a][b:b + c + length - 1] for a, b, c in zip(d, lo, n)]
        for shard in (1 << 20, 40):
            found = substring.duplicates(ctx, d, np.zeros(len(d), np.int64), lo, length, shard)
            got = collections.defaultdict(set)
            for c, o in found.tolist():
                got[int(d[c])].add(int(lo[c] + o))
            seen = set()
            for i, t in enumerate(texts):
                want = set()
                for p in range(len(t) - length + 1):
                    if t[p:p + length] in seen:
                        want.add(p)
                    seen.add(t[p:p + length])
                assert got[i] == want


def test_suffix_array_and_common_prefixes():
    rng = random.Random(4)
    for _ in range(60):
        t = bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(0, 80))) * rng.randint(1, 3)
        text = np.frombuffer(t, np.uint8)
        sa = substring.suffix_array(text, 12)
        assert [t[i:i + 12] for i in sa] == sorted(t[i:i + 12] for i in range(len(t)))
        if len(t):
            lcp = substring.common_prefixes(text, sa, 12)
            for x, y, got in zip(sa[:-1], sa[1:], lcp[1:]):
                want = next((d for d in range(12) if max(x, y) + d >= len(t) or t[x + d] != t[y + d]), 12)
                assert got == want


def test_substring_dedup(spark):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefghij é") for _ in range(180))
    rows = [(i, "".join(rng.choice("klmnopqr ") for _ in range(rng.randint(0, 300))) + (passage if i % 3 else "") +
             "".join(rng.choice("stuvwxyz") for _ in range(50))) for i in range(10, 40)]
    rows += [(100, "ab" * 400), (101, passage), (102, passage[:80]), (1, None), (2, ""), (103, "ab" * 60)]
    got = {r.doc_id: r for r in substring.dedup(docs_df(spark, rows)).collect()}
    want = brute_removed(sorted((i, (t or "").encode()) for i, t in rows), 100)
    for i, t in rows:
        b, cover, r = (t or "").encode(), want[i], got[i]
        kept = bytes(x for x, c in zip(b, cover) if not c)
        spans = sum(c and (p == 0 or not cover[p - 1]) for p, c in enumerate(cover))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    out = {r.doc_id: r.text for r in substring.rewrite(docs_df(spark, rows)).collect()}
    assert 101 not in out and out[1] is None and out[2] == "" and out[102] == passage[:80]
    assert all(out[i] == bytes(x for x, c in zip((t or "").encode(), want[i]) if not c).decode("utf-8", "ignore")
               for i, t in rows if i in out and t is not None)
    twice = substring.dedup(docs_df(spark, [(7, passage), (7, passage), (None, passage)])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in twice) == [(-1, len(passage.encode())), (7, 0), (7, 0)]
    assert substring.dedup(docs_df(spark, rows).limit(0)).count() == 0


# --------------------------------------------------------- contamination

def edit_distance_within(probe, text):
    row = list(range(len(probe) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for j, p in enumerate(probe, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row, best = new, min(best, new[-1])
    return best


def test_alignment_equals_brute_force():
    rng = random.Random(8)
    for _ in range(150):
        m, width = rng.randint(3, 12), rng.randint(1, 6)
        p = [rng.randint(1, 3) for _ in range(m)]
        t = [rng.randint(1, 3) for _ in range(m + width)]
        cost, first, last = decontam.align(np.array([p], np.uint8), np.array([t], np.uint8), width)
        # the band holds every path whose edits keep it inside: compare where it must
        exact = edit_distance_within(p, t)
        assert cost[0] >= exact
        if width >= 5:
            wide = decontam.align(np.array([p], np.uint8), np.array([[0] * m + t + [0] * (2 * m)], np.uint8), width + 2 * m)
            assert wide[0][0] == exact


def test_decontamination(spark):
    rng = random.Random(6)
    words = [w + str(i) for i, w in enumerate(["alpha", "beta", "gamma", "delta", "omega", "sigma"] * 30)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(20)) for i in range(6)] + [(90, None), (91, "")]
    planted = []
    for i in range(60):
        t = text(60)
        if i % 4 == 0:
            body = items[i % 6][1]
            if i % 8 == 0:                        # case, signs and a few edits
                body = body.upper().replace(" ", " - ", 5).replace("A", "", 3)
            t = text(20) + ", " + body + "\n" + text(20)
        planted.append((i, t))
    it = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contaminated(docs_df(spark, planted + EDGE), it).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, i % 6) for i in range(0, 60, 4)}
    for r in got:
        if r.doc_id % 8:
            raw = dict(planted)[r.doc_id].encode()[r.start:r.end].decode()
            assert raw == items[r.item_id][1] and r.edits == 0
    kept = decontam.clean(docs_df(spark, planted + EDGE), it)
    assert kept.count() == 45 + len(EDGE) and kept.columns[0] == "doc_id"
    assert decontam.contaminated(docs_df(spark, planted), it.limit(0)).count() == 0
    blocks = list(decontam.blocks(it, block_bytes=300))
    assert len(blocks) > 1 and sum(len(set(b.item.tolist())) for b in blocks) == 6


def test_decontamination_of_passages_at_any_offset(spark):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = [(i, noise(200 + 7 * i)) for i in range(4)] + [(50, "xyzzy"), (51, "q8w9e0r1t2")]
    rows, want = [], {}
    for n in range(20):
        i, size = n % 4, rng.choice([76, 80, 81, 85, 90, 95, 120])
        at = rng.randrange(0, len(items[i][1]) - size)
        piece = list(items[i][1][at:at + size])
        for _ in range(rng.choice([0, 0, 4, 7, 11])):
            j = rng.randrange(len(piece))
            piece[j:j + 1] = rng.choice([[], [rng.choice(letters)], [piece[j], "7"]])
        rows.append((n, noise(rng.randrange(90)) + "".join(piece) + noise(rng.randrange(90))))
    rows += [(200, noise(30) + " XyZzY. "), (201, noise(30) + " xyzy "), (202, noise(9) + "q8w9e1r1t2" + noise(9)),
             (203, noise(9) + "q8w9f1r1t2" + noise(9)), (204, items[2][1])]
    for n, t in rows:
        for i, item in items:
            item, t = item.lower(), " ".join(html_free(t))
            size = min(80, len(item))
            costs = [edit_distance_within(item[s:s + size], t) for s in range(len(item) - size + 1)] \
                if n >= 200 or i == n % 4 else [99]
            good = [x for x in costs if x <= size // 10]
            if good:
                want[n, i] = (min(good), len(good))
    got = {(r.doc_id, r.item_id): (r.edits, r.probes) for r in decontam.contaminated(
        docs_df(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want
    assert {(200, 50), (202, 51)} <= set(want) and not {(201, 50), (203, 51)} & set(want)


# ----------------------------------------------------------------- top-k

@pytest.mark.parametrize("scale", [1, 3e5])
def test_topk_against_brute_force(spark, scale):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) * scale for x in rng.normal(size=20)]) for i in range(300)]
    rows += [(400, None), (450, [1.0, None]), (500, [float("nan")] * 20), (550, [float("inf")] * 20), (600, [1.0, 2.0]),
             (None, [1.0] * 20), (7, rows[7][1]), (650, rows[3][1]), (701, rows[3][1]), (702, rows[3][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, tile int")
    got = collections.defaultdict(list)
    for r in topk.search(df, query=lambda c: c % 50 == 0, k=5, tile=37).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    ints = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            ints[i] = [math.floor(256 * x) for x in v]
    for q in [i for i in ints if i % 50 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
        hold = lambda x: max(-2 ** 63, min(2 ** 63 - 1, x))
        assert got.get(q, []) == [(i, hold(-s)) for s, i in scores[:5]]
    assert topk.search(df.limit(0), query=lambda c: c % 50 == 0).count() == 0


def test_topk_spreads_an_id_of_many_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(7, [float(x) for x in rng.normal(size=4)], 4) for _ in range(400)]
    df = spark.createDataFrame(rows + rows[:1] * 200, "vec_id long, v array<double>, dim int")
    once = topk.distinct_integers(df, 256)
    assert once.count() == len({tuple(math.floor(256 * x) for x in v) for _, v, _ in rows})
    packed, n = topk.tiles(once, 50, 1, "topk_hot_id")
    sizes = [len(r.ids) // 8 for r in packed.collect()]
    assert len(sizes) == n >= 7 and max(sizes) < 120


def test_topk_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF001}/embeddings.parquet')")
    want = con.execute(ORACLE["op9_topk"]).fetchall()
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in QUERIES["op9_topk"](spark, SF001).collect()]
    assert sorted(got) == sorted(want)


# ------------------------------------------------------------------ HTML

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li><li>About</li></ul></nav><div class="cookie-notice">We use cookies.</div>
<div id=main><div class="sidebar"><p>Latest news, more news.</p></div><article><h1>A  title</h1><p>First <b>bold<br>text</b>,
with&nbsp;references &lt;here&gt; &#233;.<p>Second paragraph, quite long, with words. And more words, and so on.</p>
<form><input value=x>Sign up</form><div class="ad-box ads">Buy now.</div><ul><li>one<li>two</ul><p>Short.</p></article>
<section class="comments"><p>Great article, thanks a lot, really!</p></section></div><footer>&copy; 2024</footer></body></html>"""


def test_main_text(spark):
    want = ("A title\nFirst bold text, with references <here> é.\nSecond paragraph, quite long, with words. "
            "And more words, and so on.\none\ntwo\nShort.")
    assert html.main_text(PAGE) == want
    assert html.main_text("") == html.main_text("<nav>menu</nav>") == html.main_text("<!-- only") == ""
    assert html.main_text("plain words, no tags.") == "plain words, no tags."
    assert html.main_text("<p>a &amp b<p unclosed") == "a & b"
    pages = spark.createDataFrame([(1, "u", PAGE, "z"), (2, None, None, "z"), (None, "u", "<p>x", "z"), (1, "u", PAGE, "z")],
                                  "page_id long, url string, html string, text string")
    got = html.extract(pages).collect()
    assert sorted(r.n_chars for r in got) == [0, 1, len(want), len(want)]
    assert all(r.n_chars == len(r.text) for r in got)


def test_main_text_of_several_containers():
    part = lambda n: ("Words of the article, and more of them. " * n).strip()
    page = f"<body><nav>Home</nav><div id=content><div class=part><p>{part(22)}</p></div><div class=part><p>{part(5)}</p></div></div>"
    assert html.main_text(page) == part(22) + "\n" + part(5)
    page = f"<body><div id=c><p>{part(4)}</p><ul>" + f"<li>{part(4)}</li>" * 6 + "</ul></div><footer>Foot.</footer>"
    assert html.main_text(page) == "\n".join([part(4)] * 7)
    page = f"<article><h2>Head</h2><p>Short.</p><section><p>{part(30)}</p><p>{part(20)}</p></section></article>"
    assert html.main_text(page) == "\n".join(["Head", "Short.", part(30), part(20)])


def test_main_text_in_layout_wrappers_and_forms():
    body = "Words of the article, and more of them. " * 9
    want = "Head\n" + body.strip()
    for name in ("layout with-sidebar", "page no-sidebar", "sidebar-left-layout", "content has-social"):
        for inner in (f"<article><h1>Head</h1><p>{body}</p></article>", f"<h1>Head</h1><p>{body}</p>"):
            page = f'<body><div class="{name}">{inner}<div class="sidebar"><p>Latest news.</p></div></div></body>'
            assert html.main_text(page) == want
            assert html.main_text(f"<body><form id=aspnet>{page}<form class=search>Search</form></form>") == want
    assert html.main_text(f"<main><div class='no-sidebar'><h1>Head</h1><p>{body}</p></div></main>") == want


# ------------------------------------------------------ queries, pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs.collect()
    bench = [" ".join(html_free(r.text)) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    steps = dict(cp.STAGES)
    assert list(steps) == ["language_id", "near_dedup", "substring_dedup", "decontamination", "packing"]
    one = cp.stage(steps["language_id"](spark, docs, SF001), "t1")
    assert {r.doc_id for r in one.collect()} == {r.doc_id for r in rows if any(c.isalpha() for c in r.text or "")}
    two = cp.stage(steps["near_dedup"](spark, one, SF001), "t2")
    comps = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in one.collect()], 2)
    assert sorted(r.doc_id for r in two.collect()) == sorted(comps.values())
    three = cp.stage(steps["substring_dedup"](spark, two, SF001), "t3")
    cover = brute_removed(sorted((r.doc_id, r.text.encode()) for r in two.collect()), 100)
    kept = {r.doc_id: bytes(x for x, c in zip(r.text.encode(), cover[r.doc_id]) if not c) for r in two.collect()}
    assert {r.doc_id: r.text for r in three.collect()} == {i: t.decode("utf-8", "ignore") for i, t in kept.items() if t}
    assert all(r.n_chars == len(r.text) for r in three.collect())
    four = cp.stage(steps["decontamination"](spark, three, SF001), "t4")
    left = {r.doc_id for r in four.collect()}
    for r in three.collect():
        hit = any(b in " ".join(html_free(r.text)) for b in bench if len(b) >= 80)
        assert (r.doc_id not in left) if hit else True
    assert len(left) >= 0.9 * len(kept)
    for s in (one, two, three, four):
        assert s.columns == docs.columns
    five = cp.run(spark, SF001)
    assert {r.doc_id for r in five.select("doc_id").collect()} == left


def html_free(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def test_registered_queries(spark):
    assert [q.split("_")[0] for q in QUERIES if q.startswith("op")] == [f"op{i}" for i in range(1, 14)]
    n = spark.read.parquet(f"{SF001}/documents.parquet").count()
    for name in ("op3_toxicity", "op4_language_id", "op8_quality"):
        out = QUERIES[name](spark, SF001)
        assert out.count() == n and dict(out.dtypes)["held_out"] == "boolean"
    held = QUERIES["op4_language_id"](spark, SF001).where("held_out")
    assert {r.doc_id for r in held.collect()} == {i for i in range(n) if zlib.crc32(str(i).encode()) % 3 == 1}


# ------------------------------------------------------- conversation trie

def trie_brute(rows):
    """The contract, word by word, over (conv_id, turn, role, text) tuples."""
    turns = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + v[h:]
    nodes = collections.defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in nodes if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(k))
        out.append((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


CONV = "conv_id long, turn long, role string, text string, c long, depth string, node int"


def conversations_df(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 1) for r in rows], CONV)


def random_conversations(rng, n, vocabulary):
    rows = []
    for c in rng.sample(range(-40, 400), n):
        for t in range(rng.randrange(1, 14)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(vocabulary)))
    return rows


@pytest.mark.parametrize("bucket,last_runs", [(4, 3), (8192, 4096)])
def test_trie_against_brute_force(spark, bucket, last_runs):
    rng = random.Random(5)
    rows = random_conversations(rng, 60, ["a", "", None, "é" * 3])
    rows += [(1000 + i, t, "user", f"same {t}") for i in range(30) for t in range(4)]       # copies
    rows += [(3, None, "user", "first"), (3, None, "user", "first"), (3, 2, "user", "tie"), (3, 2, "user", "eit")]
    rows += [(None, 1, "user", "no id"), (7001, 0, "user", "alone")]
    rows += [(5000, t, "user", f"long {t % 7}") for t in range(700)]
    got = trie.trie(conversations_df(spark, rows), bucket=bucket, last_runs=last_runs)
    assert sorted(map(tuple, got.collect()), key=str) == trie_brute(rows)


def test_trie_of_empty_and_turnless(spark):
    assert trie.trie(conversations_df(spark, []).limit(0)).count() == 0
    # 3 borrows five turns at most and has none of its own after them: a member of the root only
    turnless = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(turnless, 0, "user", "gone")]
    got = trie.trie(conversations_df(spark, rows)).collect()
    assert [tuple(r) for r in got] == trie_brute(rows) and got[0].depth == 0


def test_list_rank_of_a_shuffled_list(spark):
    order = list(range(500))
    random.Random(2).shuffle(order)
    arcs = spark.createDataFrame(list(zip(order, order[1:] + [-1])), "a long, after long")
    got = {r.a: r.position for r in trie.list_rank(arcs, bucket=8, last_runs=20).collect()}
    assert got == {a: i for i, a in enumerate(order)}


def test_trie_digest_of_many_ends(spark):
    ends = spark.createDataFrame([(i % 3 if i % 5 else 9, i) for i in range(4000)], "node long, c long")
    got = {r.node: r.ends_sha256 for r in trie.ends_digest(ends).collect()}
    for node in (0, 1, 2, 9):
        ids = [i for i in range(4000) if (i % 3 if i % 5 else 9) == node]
        assert got[node] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


# ------------------------------------------------------- spelling variants

def one_edit(w, x):
    if len(w) == len(x):
        return sum(a != b for a, b in zip(w, x)) == 1
    w, x = sorted((w, x), key=len)
    return len(x) == len(w) + 1 and any(x[:i] + x[i + 1:] == w for i in range(len(x)))


def variants_brute(rows):
    lower = {c: c + 32 for c in range(65, 91)}
    n = collections.Counter()
    for doc, text in rows:
        run = ""
        for ch in (text or "").translate(lower) + " ":
            if "a" <= ch <= "z" or "\u00c0" <= ch <= "\u00ff":
                run += ch
                continue
            if run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                if h % 199 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                n[run] += 1
            run = ""
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    by_length = collections.defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    form, near = {}, {}
    for w in n:
        x = [x for d in (-1, 0, 1) for x in by_length[len(w) + d] if one_edit(w, x)]
        near[w] = len(x)
        best = min(x, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w
    return sorted((w, form[w], root(w), n[w], near[w], n[form[w]] if form[w] else None) for w in n)


def misspelt_rows(rng):
    letters = "abcé"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 10))) for _ in range(60)]
    rows, doc = [], 0
    for w in words:
        other = list(w)
        other[rng.randrange(len(w))] = rng.choice(letters)
        third = list(other)
        third.insert(rng.randrange(len(w)), rng.choice(letters))
        text = " ".join([w] * rng.choice([5, 30, 160]) + ["".join(other)] * rng.choice([0, 6, 30]) + ["".join(third)] * 5)
        rows.append((doc, text.upper() if doc % 7 == 0 else text))
        doc += 1
    return rows


@pytest.mark.parametrize("bucket_chars,file_words", [(65_536, 4_096), (300, 6), (60, 1)])
def test_variants_against_brute_force(spark, bucket_chars, file_words):
    rows = misspelt_rows(random.Random(3)) + EDGE + [(None, "straße straße, straße; straße straße")]
    rows += [(200 + i, "aaaaaaa aaaaaa aaaaaaaa " + "prefix" + chr(97 + i % 26) + "x ") for i in range(160)]   # a hot half
    got = spelling.variants(docs_df(spark, rows), bucket_chars=bucket_chars, file_words=file_words)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == variants_brute(rows)


def test_variants_of_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = spelling.variants(docs_df(spark, rows)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == variants_brute(rows)
    assert spelling.variants(docs_df(spark, []).limit(0)).count() == 0
    assert spelling.variants(docs_df(spark, [(1, None), (2, "")])).count() == 0


def test_near_words_in_any_zones():
    rng = random.Random(8)
    for size in (1, 2, 40, 150):
        words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(4, 9))) for _ in range(size)})
        query, a, b = [], [], []
        for i, w in enumerate(words):
            cuts = sorted({0, len(w), *(rng.randrange(len(w)) for _ in range(rng.randrange(4)))})
            for x, y in zip(cuts, cuts[1:]):
                query.append(i), a.append(x), b.append(y)
        query, a, b = map(np.array, (query, a, b))
        row, near = spelling.near_words(words, query, a, b)
        assert sorted((words[query[i]], words[j]) for i, j in zip(row, near)) \
            == sorted((w, x) for w in words for x in words if one_edit(w, x))


# ------------------------------------------------------ nearest neighbours

def cosine(x, y):
    x, y = np.array(x, float), np.array(y, float)
    return (x * y).sum() / np.sqrt((x * x).sum()) / np.sqrt((y * y).sum())


def vectors_df(spark, rows):
    return spark.createDataFrame([(i, v, 1, "z") for i, v in rows], "vec_id long, embedding array<float>, part int, ids string")


def neighbours_brute(rows, queries, k=5):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for i, v in good:
        if i in queries:
            for j, w in good:
                if j != i and len(w) == len(v):
                    out.setdefault(i, {})[j] = max(out.get(i, {}).get(j, -2), cosine(v, w))
    return {i: sorted(s.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k] for i, s in out.items()}


def by_query(found):
    out = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_neighbours_edge_cases(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(120)]
    rows += [(200 + i, [1.0, 2.0, 0.0, 0.0, 0.0, -0.0]) for i in range(60)]                     # a hot vector, ties
    rows += [(300, None), (350, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (400, [float("nan")] * 6), (450, [float("inf")] * 6),
             (500, [0.0] * 6), (None, [1.0] * 6), (550, [1.0, 2.0]), (600, [2.0, 1.0]), (650, []), (700, [3.0]),
             (50, rows[50][1]), (750, rows[1][1]), (750, rows[2][1])]
    got = by_query(ann.search(vectors_df(spark, rows), query=lambda c: c % 50 == 0, block=16).collect())
    want = neighbours_brute(rows, set(range(0, 1000, 50)))
    assert set(got) == set(want)
    for i, w in want.items():
        assert [v for v, _ in got[i]] == [v for v, _ in w], i
        assert np.allclose([s for _, s in got[i]], [s for _, s in w], atol=1e-12)
    assert ann.search(vectors_df(spark, rows).limit(0)).count() == 0


def test_neighbours_recall_in_parts(spark):
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(40, 16))
    x = middle[rng.integers(0, 40, 3000)] + 0.6 * rng.normal(size=(3000, 16))
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    df = vectors_df(spark, rows)
    router = ann.fit(ann.entries(ann.usable(df), 5), parts=16)[16]
    assert router.parts == 16 and router.probes < 12          # the parts do save work on such data
    got = by_query(ann.search(df, query=lambda c: c % 50 == 0, parts=16, block=100).collect())
    want = neighbours_brute(rows, set(range(0, 3000, 50)))
    hits = sum(len({v for v, _ in got[i]} & {v for v, _ in w}) for i, w in want.items())
    assert set(got) == set(want) and hits >= 0.9 * 5 * len(want)
    for i, w in got.items():
        assert len(w) == 5 and all(abs(s - cosine(rows[i][1], rows[v][1])) < 1e-12 for v, s in w)


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(2)
    x = ann._unit(np.repeat(rng.normal(size=(8, 10)), 100, axis=0) + 0.3 * rng.normal(size=(800, 10)))
    graph = ann.neighbour_graph(x)
    part = ann.balanced_parts(x, graph, 8)
    start = ann.halved(x, 8)
    cut = lambda p: (p[graph] != p[:, None]).mean()
    assert np.bincount(part, minlength=8).max() <= 111 and cut(part) < cut(start)


# ------------------------------------------- mended: names, samples, pieces

def test_stages_keep_columns_of_any_name(spark):
    names = ["_run_k", "_run_v", "_runs", "_kept_k", "_kept_v", "k", "v", "_own0", "_OWN1"]
    line = "this line of more than one hundred bytes is repeated in several documents of the table, word for word, "
    rows = [(i, f"text number {i} " + line * (i % 2) + f"end {i}", *[f"{n}{i}" for n in names]) for i in range(8)] \
        + [(None, None, *names), (None, "", *names)]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    for out in (substring.rewrite(docs), simhash.representatives(docs)):
        assert out.columns == docs.columns and out.count() > 0
        for r in out.collect():
            if r["doc_id"] is not None:
                assert [r[n] for n in names] == [f"{n}{r['doc_id']}" for n in names]
        assert out.limit(0).count() == 0
    assert substring.rewrite(docs.limit(0)).count() == 0 and simhash.representatives(docs.limit(0)).count() == 0
    cut = {r["doc_id"]: r["text"] for r in substring.rewrite(docs).collect()}
    assert line in cut[1] and line[3:-3] not in cut[3]


def test_hashed_sample_with_missing_ids(spark):
    rows = [(common.NO_ID if i % 3 == 0 else i, f"text {i % 1500}", "en" if i % 5 else "de") for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, text string, lang string").withColumn("v", F.xxhash64("text")).select("k", "v", "lang")
    take = lambda d: sorted(map(tuple, common.hashed_sample(d, "lang", 300, ("k", "v")).collect()))
    a, b = take(df), take(df.repartition(7))
    assert a == b and len(a) == len(set(a))
    missing = sum(k == common.NO_ID for k, _, _ in a) / len(a)
    # rows without an id and equal in text are one: 500 of 4,500 distinct rows
    assert 0.03 < missing < 0.35 and 200 < len(a) < 800


def test_language_id_with_a_third_of_ids_missing(spark):
    texts = {"en": "the quick brown fox jumps over the lazy dog and runs away from the old house",
             "de": "der schnelle braune Fuchs springt \u00fcber den faulen Hund und l\u00e4uft vom alten Haus weg"}
    rows = [(None if i % 3 == 0 else i + 1000 * (g == "de"), texts[g] + f" {chr(97 + i % 26)}{chr(97 + i // 26)}", g, "x", 1)
            for i in range(400) for g in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, v string, k int")
    a, b = langid.fit(docs, per_language=80, landmarks=40), langid.fit(docs.repartition(5), per_language=80, landmarks=40)
    assert np.array_equal(a.landmarks, b.landmarks)
    got = langid.predict(docs, a).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("lang_pred <> lang").count() == 0


def test_long_words_are_read_in_pieces():
    rng = random.Random(3)
    long = bytes(rng.choice(b"abcdefghij") for _ in range(300))
    raw = np.frombuffer(b"short " + long + b" tail x", np.uint8)
    c, word, doc = toxicity.words(raw, np.array([0, len(raw)]))
    got = [c[word == w].astype(np.uint8).tobytes() for w in range(word.max() + 1)]
    assert got[0] == b"\x01short" and got[-1] == b"\x01x" and len(doc) == len(got) and set(doc) == {0}
    pieces = got[1:-2]
    assert max(map(len, pieces)) == toxicity.PIECE and len(pieces) > 5
    whole = pieces[0]
    for p in pieces[1:]:
        assert whole.endswith(p[:toxicity.OVERLAP])
        whole += p[toxicity.OVERLAP:]
    assert whole == b"\x01" + long


def test_insult_late_in_a_long_word_is_learned(spark):
    rng = random.Random(1)
    letters = "abcdefghijklmnoprstuvw"

    def text(toxic):
        junk = "".join(rng.choice(letters) for _ in range(260))
        return " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(12)) + " " + junk + ("zyxqzk" if toxic else "") \
            + "".join(rng.choice(letters) for _ in range(40))
    rows = [(i, text(i % 2 == 1)) for i in range(300)]
    docs = docs_df(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.predicted for r in toxicity.predict(docs, model).collect()}
    right = sum(got[i] == i % 2 for i in range(200, 300))
    assert right >= 90


def test_warc_reader_deals_bundles_out(spark, tmp_out):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>") for i in range(120)], "page_id long, url string, html string")
    folder = f"file://{tmp_out}/spread"
    index = warc.write_bundles(pages.repartition(4), folder, frame_bytes=64, bundle_frames=2)
    bundles = index.select("bundle").distinct().count()
    parts = warc.read_bundles(index, folder).select(F.spark_partition_id().alias("p")).distinct().count()
    assert bundles > 8 and parts == min(bundles, common.shuffle_partitions(spark))


# ------------------------------------------------------ HTML by path ratios

LONG = "A sentence of the article, with words, and then some more of them. "


def paragraphs(n, size=5):
    return [f"({i}) " + (LONG * size).strip() for i in range(n)]


@pytest.mark.parametrize("wrapper", ['<div title="the hidden gem">', '<div style="overflow: hidden !important">',
                                     '<div class="text hidden md:block">', "<div data-x='display:none'>", "<div hidden-note=1>"])
def test_attributes_that_do_not_hide(wrapper):
    body = paragraphs(3)
    page = f"<body>{wrapper}<h1>Head</h1>" + "".join(f"<p>{p}</p>" for p in body) + "</div></body>"
    assert html.main_text(page) == "\n".join(["Head", *body])


@pytest.mark.parametrize("attribute", ["hidden", "hidden=''", "aria-hidden='true'", "style='color:red; display:  none'"])
def test_hidden_parts_go(attribute):
    body = paragraphs(4)
    page = "<article>" + "".join(f"<p>{p}</p>" for p in body) + f"<div {attribute}><p>Not shown, not at all.</p></div></article>"
    assert html.main_text(page) == "\n".join(body)


def test_readers_comments_go_whatever_their_size():
    text, remarks = paragraphs(1)[0], "".join(f"<p>{p}</p>" for p in paragraphs(3, 8))
    for area in ('<section class="comments">', '<div id="disqus_thread">', '<ol class="comment-list">', "<div class='user-comments box'>",
                 '<article class="comment">'):
        page = f"<article><p>{text}</p>{area}{remarks}</{area[1:].split()[0]}></article>"
        assert html.main_text(page) == text, area
    assert html.main_text(f"<div class=comments>{remarks}</div>") == ""
    # a name that only holds the word is none
    assert html.main_text(f'<article class="no-comments"><p>{text}</p></article>') == text
    assert html.main_text(f'<div class="commentary"><p>{text}</p></div>') == text


def test_names_that_only_hold_a_word():
    body = paragraphs(3)
    for name in ("social-history", "share-prices", "headers-and-footers-explained", "menu-of-the-day", "advertising-law"):
        page = f'<article><p>{body[0]}</p><div class="{name}"><p>{body[1]}</p></div><p>{body[2]}</p></article>'
        assert html.main_text(page) == "\n".join(body), name
    for name in ("social-share", "site-footer", "mainNav", "sidebar-left", "cookie-notice", "related posts-list", "adBox"):
        page = f'<article><p>{body[0]}</p><div class="{name}"><p>Some words, of no account.</p></div><p>{body[2]}</p></article>'
        assert html.main_text(page) == "\n".join([body[0], body[2]]), name


def test_a_page_with_neutral_names():
    body = paragraphs(5)
    menu = "".join(f"<li><a href=/{w}>{w}</a></li>" for w in ("Home", "News", "Sport", "Contact"))
    page = (f"<body><div class=x1><ul>{menu}</ul></div><div class=x2><p>Buy now!</p></div><div class=x3><h1>Head</h1><p class=b>By A. Writer</p>"
            f"<p>{body[0]}</p><h2>Part</h2><p>{body[1]}</p><ul><li>one</li><li>two</li></ul><p>{body[2]}</p><p>Short.</p><p>{body[3]}</p>"
            f"<div class=x9>Tags: <a href=/a>a</a> <a href=/b>b</a></div></div><div class=x4>(c) 2024 Corp</div></body>")
    assert html.main_text(page) == "\n".join(["Head", "By A. Writer", body[0], "Part", body[1], "one", "two", body[2], "Short.", body[3]])


def paths_brute(items):
    """Content paths from (path, text, link length), by the definition."""
    names = [p for p, _, _ in items]
    ratio = {}
    for p in set(names):
        own = [(t, k) for q, t, k in items if q == p]
        length = sum(len(t) - k for t, k in own) / len(own)
        marks = sum(sum(c in ".,;:!?\u3002\uff0c\u2026" for c in t) for t, _ in own) / len(own)
        ratio[p] = length * (1 + marks)
    raw = [ratio[p] for p in names]
    smooth = np.convolve(np.concatenate(([raw[0]], raw, [raw[-1]])), [0.25, 0.5, 0.25], "valid")
    cut = min(smooth.mean(), smooth.std())
    return {p for p in names if np.mean([min(s, 2 * ratio[p]) for q, s in zip(names, smooth) if q == p]) >= cut * (1 - 1e-12)}


def test_content_paths_against_brute_force():
    rng = random.Random(9)
    for _ in range(40):
        items, page = [], ""
        for box in range(rng.randrange(2, 7)):
            name, tag = f"z{rng.randrange(9)}", rng.choice(["p", "li", "h2", "td"])
            inner = ""
            for _ in range(rng.randrange(1, 6)):
                text = " ".join(rng.choice(["word", "and,", "end.", "more"]) for _ in range(rng.choice([1, 4, 30, 80])))
                link = rng.random() < 0.3
                items.append((f"/div.{name}/{tag}.q", text, len(text) if link else 0))
                inner += f"<{tag} class=q>" + (f"<a href=/x>{text}</a>" if link else text) + f"</{tag}>"
            page += f"<div class={name}>{inner}</div>"
        found = html.blocks(page)
        assert [(b.element.path, b.text, b.linked) for b in found] == items
        assert html.content_paths(found) == paths_brute(items)


def test_neutral_pages_give_their_article():
    rng = random.Random(4)
    for _ in range(60):
        names = rng.sample([f"c{i}" for i in range(50)], 6)
        body = [p for p in paragraphs(rng.randrange(3, 12), 4)]
        links = "".join(f"<li><a href=/{i}>entry {i}</a></li>" for i in range(rng.randrange(3, 15)))
        inner, want = "<h1>The headline</h1>", ["The headline"]
        for i, p in enumerate(body):
            inner += f"<p>{p}</p>"
            want.append(p)
            if i < len(body) - 1 and rng.random() < 0.4:
                extra, tag = rng.choice([("A heading", "h2"), ("brief", "p"), ("a quote of it", "blockquote")])
                inner += f"<{tag}>{extra}</{tag}>"
                want.append(extra)
        before = f"<div class={names[0]}><ul>{links}</ul></div>" + (f"<div class={names[1]}>Great offer today</div>" if rng.random() < 0.5 else "")
        after = f"<div class={names[2]}><ul>{links}</ul></div><div id={names[3]}>All rights kept</div>"
        assert html.main_text(f"<body>{before}<div class={names[4]}>{inner}</div>{after}</body>") == "\n".join(want)
    assert html.main_text("<p>tie</p>") == "tie" and html.main_text("<p>a.</p><p>b.</p>") == "a.\nb."


def test_extract_of_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.extract(pages).count() == 0


def test_repeated_rows_do_not_pile_up(spark):
    """One row 300 times: its places reach a task once, not once per copy."""
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(210))
    rows = [(7, text)] * 300 + [(i, text[i * 10:] + f" tail {i}") for i in range(10, 14)]
    docs = docs_df(spark, rows).repartition(6)
    narrow = docs.select(F.col("doc_id").alias("k"), F.xxhash64("text").alias("v"), "text")
    survey = narrow.mapInArrow(lambda it: substring._survey(it, 100, 20, 32), "bucket int, blob binary")
    at = (survey.repartition(8, "bucket").mapInArrow(substring._repeated, "k long, v long, at binary")
          .groupBy("k", "v").agg(F.sum(F.length("at")).alias("bytes")))
    once = len(text) * 2 * substring._STRETCH.itemsize
    assert at.agg(F.max("bytes")).first()[0] <= once
    got = substring.dedup(docs).collect()
    assert [r.n_removed for r in got if r.doc_id == 7] == [0] * 300
    assert all(r.n_removed >= len(text) - r.doc_id * 10 for r in got if r.doc_id > 7)


def test_topk_sql_on_repeated_rows_and_shared_ids(spark):
    rows = [(50, [0.5, 0.25]), (50, [0.5, 0.25]), (50, [0.1, 0.1]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [0.5, 2.0]),
            (2, [0.5, 0.5]), (3, None), (4, [1.0, None]), (100, [3.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    want = con.execute(ORACLE["op9_topk"]).fetchall()
    got = [tuple(r) for r in topk.search(df, query=lambda c: c % 50 == 0).select("query_id", "rank", "vec_id", "score").collect()]
    key = lambda r: (r[0], r[1])
    assert [(q, r, s) for q, r, _, s in sorted(got, key=key)] == [(q, r, s) for q, r, _, s in sorted(want, key=key)]
    assert sorted(got) == sorted(want)


def test_hot_line_spreads_over_buckets(spark):
    """A line of 52 bytes in every document, between texts that differ: its
    anchors are hot, and their stretches go to many buckets."""
    rng = random.Random(6)
    word = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n))
    line = "one line of fifty-two bytes that all documents hold."
    rows = [(i, word(40) + line + word(40)) for i in range(600)]
    twice = rows[3][1][200:420]
    rows += [(1000 + i, word(5) + twice + word(3)) for i in range(3)]
    docs = docs_df(spark, rows).repartition(24)
    narrow = docs.select(F.col("doc_id").alias("k"), F.xxhash64("text").alias("v"), "text")
    survey = narrow.mapInArrow(lambda it: substring._survey(it, 100, 20, 800), "bucket int, blob binary")
    known = survey.repartition(8, "bucket").mapInArrow(lambda it: substring._repeated(it, 8), "k long, v long, at binary").cache()
    hot = substring.hot_anchors(known)
    assert 1 <= len(hot) <= 60 and (np.diff(hot.astype(np.float64)) > 0).all()
    ats = known.where("k is not null").groupBy("k", "v").agg(F.collect_list("at").alias("ats"))
    zipped = narrow.mapInArrow(substring._zipped, "k long, v long, size long, z binary")

    def shares(hot):
        out = (zipped.join(ats, ["k", "v"]).mapInArrow(lambda it: substring._contexts(it, 100, 800, hot),
                                                       "bucket int, place binary, hash binary, body binary")
               .where("body is not null").groupBy("bucket").agg(F.sum(F.length("place")).alias("b")).collect())
        return max(r.b for r in out) / sum(r.b for r in out)

    assert shares(None) > 0.15 and shares(hot) < 0.05
    want = {i: sum(c) for i, c in brute_removed(sorted((i, t.encode()) for i, t in rows), 100).items() if any(c)}
    assert set(want) == {1000, 1001, 1002} and min(want.values()) >= 220
    for slices in (2, substring.HOT_SLICES):
        runs = substring.find_runs(narrow, hot_slices=slices).collect()
        spans = {r.k: substring.removed_spans(b"".join(r.runs), 100) for r in runs}
        assert {k: int((x[:, 1] - x[:, 0]).sum()) for k, x in spans.items()} == want


def test_packing_remembers_a_million_words():
    """op2: what a worker reads again and again is not forgotten after some 40 MB; forgetting changes no id."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from sessionlab.llm import packing
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    keep, forget = packing.ChunkEncoder(tokenizer), packing.ChunkEncoder(tokenizer)
    keep.known = {str(i): b"" for i in range(1_000_000)}
    keep(["once more"])
    assert len(keep.known) > 1_000_000
    forget.REMEMBERED = 1
    texts = ["Some Words, again and again.", "again: other words\nSome", ""] * 3
    fresh = packing.ChunkEncoder(tokenizer)
    assert [forget([t])[0] for t in texts] == fresh(texts)


def test_pipeline_workers_hold_little(spark):
    """pipeline: a worker lets go of packing's words when it reads for another operator, and a stage copies a run of
    rows at a time, not a whole Arrow batch."""
    pytest.importorskip("public_tokenizers")
    path = tokenizer_path()
    words = packing.encoder(path)
    assert len(words(["some words"])[0]) > 0 and packing.encoder(path) is words
    batch = pa.RecordBatch.from_arrays([pa.array(range(600)), pa.array(["some text " * 100] * 599 + [None])], names=["k", "text"])
    list(packing._pack([pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).fill_null("")], names=["k", "text"])],
                       path, 1, 2048))
    assert packing.encoder(path) is words
    list(langid._predict([batch.slice(0, 5)], None))
    assert packing.encoder(path) is not words
    runs = []
    got = list(common.judged([batch], 1, 100_000, lambda part: runs.append(part.num_rows) or [k % 2 == 0 for k in part.column("k").to_pylist()]))
    assert max(runs) == 100 and sum(runs) == 600
    assert pa.Table.from_batches(got).column("k").to_pylist() == list(range(0, 600, 2))
    assert [b.num_rows for b in common.few([batch], 250)] == [250, 250, 100] and not list(common.few([batch.slice(0, 0)]))
    docs = docs_df(spark, EDGE)
    assert langid.determined(docs, None).count() == 0 and substring.rewrite(docs).where("doc_id = 2").count() == 1
