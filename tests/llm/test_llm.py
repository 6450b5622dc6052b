"""Training-data operators against brute force, on small hand-made tables with nulls, ties, repeats and clashing names."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsweft.llm import bpe, components, fingerprints, lm_scoring, near_dedup, packing, pipeline, quality_lm, quality_rules, queries, substring_dedup, token_files, units, warc, words
from newsweft.llm.scratch import new_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, unit_id string, rows int, shard int, n_words string, kept string"
WS = r"[^\x20\x09-\x0D]+"


def corpus():
    r = random.Random(3)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(300)]
    base = [" ".join(r.choice(vocab) for _ in range(r.randint(15, 120))) for _ in range(25)]
    out = []
    for i, t in enumerate(base):
        out.append(t)
        w = t.split()
        if i % 3 == 0:
            out += [t, t.upper()]
        if i % 2 == 0:
            w[len(w) // 2] = "changed"
            out.append(" ".join(w))
        if i % 4 == 0:
            out.append(" ".join(w[: len(w) // 2]) + " new tail " + base[(i + 1) % 25][:150])
    out += ["", None, "   \n\t ", "one", "one two three", "one two three", "ONE two\nthree", "a\x0bb\x0cc", "日本 🙂 text", "x" * 5000, "word " * 400, "line\nline\nother\n\nline #tag* <b>"]
    rows = [(i * 7 % 1009, t, ["en", "fr", None][i % 3], "s", None, "u", 1, 2, "w", "k") for i, t in enumerate(out)]
    rows.append((None, base[0], "en", "s", 1, "u", 1, 2, "w", "k"))
    rows.append(rows[3])
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(t):
    return (t or "").encode().split()


def test_words_hash():
    w = words.Words([b"a bc", None, b"BC  a\x0b"], lower=True)
    assert w.counts.tolist() == [2, 0, 2]
    assert w.hashes[0] == w.hashes[3] and w.hashes[1] == w.hashes[2]


def test_near_dedup(docs, rows, empty):
    sets = {}
    for i, t, *_ in rows:
        if i is not None:
            w = (t or "").encode().lower().split()
            sets[i] = {tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            if a < b and n and 100 * n >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    for kw in ({}, {"node": 3, "levels": 1}):
        got = near_dedup.near_duplicates(docs, **kw).collect()
        assert len(got) == len(rows)
        for r in got:
            if r.doc_id is not None:
                assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root(r.doc_id), root(r.doc_id) == r.doc_id)
            else:
                assert r.kept and r.component_id is None
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_dedup_recall_at_the_last_level(spark):
    """Pairs at the threshold, followed down the trees as far as branching goes."""
    r = np.random.default_rng(11)
    pairs, n = 4000, near_dedup.COORDINATES
    a = r.integers(0, 1 << 32, (pairs, n), dtype=np.uint32)
    b = np.where(r.random((pairs, n)) < near_dedup.PERCENT / 100, a, a ^ np.uint32(1))
    rows = [(2 * i + k, sig[i].tobytes()) for k, sig in enumerate((a, b)) for i in range(pairs)]
    sigs = spark.createDataFrame(rows, "rep long, signature binary").cache()
    both = lambda d: d.groupBy("path", F.shiftright("rep", 1).alias("pair")).count().filter("count = 2").select("path", F.lit(2).cast("long").alias("n"), F.explode(F.array(2 * F.col("pair"), 2 * F.col("pair") + 1)).alias("rep")).cache()
    nodes = both(near_dedup._roots(sigs, near_dedup.TREES))
    for level in range(near_dedup.LEVELS):
        nodes = both(near_dedup._branch(nodes.join(sigs, "rep"), level))
    missed = pairs - nodes.select(F.shiftright("rep", 1)).distinct().count()
    print("missed", missed, "of", pairs)
    assert missed <= pairs // 1000


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(e).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_substring_dedup(docs, rows, empty):
    texts = [(i, split(t)) for i, t, *_ in rows]
    least = {}
    for i, w in texts:
        if i is not None:
            for j in range(len(w) - 12):
                k = tuple(w[j : j + 13])
                least[k] = min(least.get(k, i), i)
    want = collections.Counter()
    for i, w in texts:
        gone = [False] * len(w)
        if i is not None:
            for j in range(len(w) - 12):
                if least[tuple(w[j : j + 13])] < i:
                    gone[j : j + 13] = [True] * 13
        want[i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()] += 1
    for kw in ({}, {"cells_per_window": 0.01}):  # a full sketch lets more through and loses none
        got = substring_dedup.dedup_substrings(docs, carry=("source", "shard", "n_words"), **kw)
        assert got.columns == ["doc_id", "text", "n_words", "n_removed", "source", "shard"]
        assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()) == want
    assert substring_dedup.dedup_substrings(empty).count() == 0


def test_substring_dedup_large_ids(spark):
    """Ids beyond 2**53 stay exact beside a null one; rows that share an id don't cut each other."""
    t, u = (" ".join(f"{p}{i}" for i in range(30)) for p in "tu")
    big = (1 << 53) + 1
    rows = [(big, t), (None, "x"), (big, t), (None, "y"), (big - 1, u), (big, u)]
    got = substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (0, 0), (big - 1, 0), (big, 0), (big, 0), (big, 30)]


def test_sketch_keeps_its_load():
    """The share of unique windows that pass the sketch is the same for small and large inputs, and all repeated ones pass."""
    r = np.random.default_rng(5)
    for n in (40_000, 640_000):
        h = r.integers(0, 1 << 63, n).astype(np.uint64)
        h = np.concatenate([h, h[: n // 10]])
        ranges = int(len(h) * substring_dedup.CELLS_A_WINDOW) // substring_dedup.RANGE + 1
        parts, asked = np.array_split(h, 7), {}
        for u, p in enumerate(parts):
            for s, at, twice in substring_dedup.sketch_of(p, ranges):
                asked.setdefault(s, []).append((u, len(at).to_bytes(4, "little") + np.packbits(twice).tobytes() + units.squeeze_sorted(at)))
        got = {u: {} for u in range(7)}
        for s, rows in asked.items():
            for (u, _), b in zip(rows, substring_dedup.merge([], [b for _, b in rows])):
                got[u][s] = b
        passed = np.concatenate([p[substring_dedup.suspects(p, ranges, got[u])] for u, p in enumerate(parts)])
        assert set(h[: n // 10].tolist()) <= set(passed.tolist())
        assert len(np.unique(passed)) - n // 10 <= 0.2 * n


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_tokenizer())


def ids_of(library, t):
    return library.encode(t or "", add_special_tokens=False).ids


def test_bpe_tree_and_chunks(library):
    r = random.Random(5)
    enc = bpe.Encoder(bpe.default_tokenizer(), leaf=6)
    pool = ["a", "e", "th", "ing", " ", "  ", "\n", "\n\n", "\t", "'s", "'", "é", "日", "🙂", "12", "!!", "<|endoftext|>", "x" * 20, " " * 9, "　", "\x01", "\x02", "\x1c", "'ll", "word, word."]
    for _ in range(800):
        sub = r.sample(pool, r.randint(1, 4)) if r.random() < 0.5 else pool
        t = "".join(r.choice(sub) for _ in range(r.randint(0, 50)))
        want = ids_of(library, t)
        assert enc.encode(pa.array([t, None]))[0].tolist() == want
        assert enc.tree(t) == want
        assert enc.decode(np.array(want, np.uint32)) == library.decode(want, skip_special_tokens=False)


def test_encode_decode(docs, rows, empty, library):
    want = collections.Counter()
    for i, t, *_ in rows:
        ids = ids_of(library, t)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    for kw in ({}, {"long_text": 60}):
        got = bpe.encode_decode(docs, **kw).collect()
        assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert bpe.encode_decode(empty).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17])
def test_bit_packing(bits, tmp_path):
    r = np.random.default_rng(bits)
    ids = [r.integers(0, 1 << bits, n).astype(np.uint32) for n in (0, 5, 4096, 9000, 1)]
    with open(tmp_path / "x", "wb") as f:
        token_files.write_shard(f, np.arange(5), ids, bits, block=100)
    with open(tmp_path / "x", "rb") as f:
        reader = token_files.ShardReader(f)
        for i in (3, 0, 4, 1, 2):
            assert (reader.document(i) == ids[i]).all()
        assert (reader.ids(95, 305) == np.concatenate(ids)[95:305]).all()


def test_token_files(docs, rows, empty, spark, library):
    m = token_files.write_tokens(docs, new_path(spark, "t"), shard_bytes=2000)
    assert m.count() > 2
    got = token_files.read_tokens(m).orderBy("start").collect()
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda k: -math.inf if k is None else k)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in got) == collections.Counter((i, (*ids_of(library, t), 0)) for i, t, *_ in rows)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens
    assert token_files.round_trip(empty).count() == 0
    low = -(1 << 63)
    few = spark.createDataFrame([(None, "x"), (low, "y"), (None, "z")], "doc_id long, text string").coalesce(1)
    assert [r.doc_id for r in token_files.round_trip(few).orderBy("start").collect()] == [None, None, low]


def test_packing(docs, rows, empty, library):
    got = packing.pack(docs, size=64).collect()
    want = collections.Counter()
    for i, t, *_ in rows:  # every piece: where it starts, its length and its ids
        ids = [*ids_of(library, t), packing.END_ID]
        first = len(ids) % 64 or 64
        for p, (a, z) in enumerate(zip([0, *range(first, len(ids), 64)], range(first, len(ids) + 1, 64))):
            want[i, p, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes()), tuple(ids[a:z])] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want
    by_seq = collections.defaultdict(list)
    for r in got:
        by_seq[r.sequence_id].append((r.offset, r.length))
    for s in by_seq.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 64
    assert len(by_seq) <= 1.05 * math.ceil(sum(r.length for r in got) / 64)
    assert packing.pack(empty).count() == 0


def test_best_two_fit():
    counts = np.zeros(11, np.int64)
    counts[[6, 5, 4, 3, 2]] = 2, 2, 2, 2, 2
    lines = packing.plan(counts, 10)
    used = collections.Counter()
    for lengths, times in lines:
        assert sum(lengths) <= 10
        for n in lengths:
            used[n] += times
    assert used == {6: 2, 5: 2, 4: 2, 3: 2, 2: 2} and sum(t for _, t in lines) == 4


@pytest.mark.parametrize("name", ["op1_near_dedup", "op4_substring_dedup", "op6_warc"])
def test_sql_twins(spark, sf_dir, name):
    import duckdb

    db = duckdb.connect()
    for t in ("documents", "pages"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf_dir)
    want = db.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))


def test_warc_foreign_archives(spark, tmp_path):
    """Archives of other writers: other header cases, HTTP messages, no private fields, no content length."""
    import gzip

    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n<p>hi</p>"
    records = [b"WARC/1.0\r\nwarc-type: warcinfo\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n",
               b"WARC/1.0\r\nWARC-Type:response\r\nWARC-Target-URI: http://a\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(http), http),
               b"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Payload-Digest: sha1:ABC\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
               b"WARC/1.0\r\nWARC-Type: resource\r\n\r\nno length\r\n\r\n"]
    # a member hidden in stored data of another one is no record of its own
    hidden = gzip.compress(b"WARC/1.0\r\nWARC-Type: hidden\r\n\r\n", 0) + b"behind"
    records.append(b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(hidden), hidden))
    data = b"".join(gzip.compress(r, 0) for r in records)
    (tmp_path / "x.warc.gz").write_bytes(data)
    m = spark.createDataFrame([(f"file://{tmp_path}/x.warc.gz", len(data), 5)], warc.MANIFEST)
    for split in (37, 4000):
        got = {r.record_type: r for r in warc.read_warc(m, split=split).collect()}
        assert set(got) == {"warcinfo", "response", "revisit", "resource", "metadata"}
        assert bytes(got["response"].payload) == b"<p>hi</p>" and got["response"].url == "http://a" and got["response"].page_id is None
        assert (got["revisit"].payload_digest, got["revisit"].payload_bytes, got["revisit"].payload) == ("ABC", None, None)
        assert bytes(got["resource"].payload) == b"no length"


def test_warc(spark):
    r = random.Random(2)
    big = "".join(r.choice("abc<>") for _ in range(20_000))
    rows = [(5, "http://a/1", "same"), (3, "http://a/2", "same"), (9, None, None), (4, "u\r\nX: y", ""), (7, "http://b", big), (8, "http://b", big + "!"), (3, "http://a/2", "same"), (None, "n", "same"), (11, "g", "\x1f\x8b\x08 é")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = collections.Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        first = min((j for j, _, g in rows if j is not None and (g or "") == (h or "")))
        ref = first if i is None or i > first else None
        want[i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if ref is not None else "response", ref] += 1
    m = warc.write_warc(pages.repartition(2), new_path(spark, "w"))
    for size in (warc.SPLIT, 50, 700):
        got = warc.read_warc(m, split=size).collect()
        assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert {r.payload.decode() for r in got if r.payload is not None} == {h or "" for _, _, h in rows}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_quality_rules(docs, rows, empty):
    want = collections.Counter()
    for i, t, *_ in rows:
        t = t or ""
        w = re.findall(WS, t)
        lines = [x for x in t.split("\n") if re.search(WS, x)]
        n = collections.Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        hit = [False] * len(w)
        for j in range(len(w) - 4):
            if n[tuple(w[j : j + 5])] > 1:
                hit[j : j + 5] = [True] * 5
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), sum(hit), len(w) < 10 or 100 * sum(hit) > 20 * len(w)] += 1
    got = quality_rules.assess(docs)
    assert "source" in got.columns and got.columns.count("n_words") == 1
    got = got.collect()
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    import zstandard

    compress = zstandard.ZstdCompressor(level=quality_rules.LEVEL).compress
    text = collections.defaultdict(set)
    for i, t, *_ in rows:
        text[i].add((t or "").encode())
    for r in got:  # ratios and verdicts, written out plainly
        wants = set()
        for t in text[r.doc_id]:
            ratio, out, far = (len(t) / len(compress(t)) if t else 0.0), 0.0, False
            chunk = next((c for c in quality_rules.CHUNKS if len(t) >= 2 * c[0]), None)
            if chunk:
                starts = sorted({*range(0, len(t) - chunk[0], chunk[0]), len(t) - chunk[0]})
                each = [chunk[0] / len(compress(t[i : i + chunk[0]])) for i in starts]
                bad = [r < chunk[1] or r > chunk[2] for r in each]
                out = sum(bad) / len(starts)
                far = min(each) < 0.97 * chunk[1] or max(each) > 1.03 * chunk[2] or any(bad[k] and bad[k + 1] for k in range(len(bad) - 1))
            band = min((b for b in quality_rules.BANDS if b.below > len(t)), key=lambda b: b.below)
            wants.add((ratio, out, far, not r.base_failed and band.least <= ratio <= band.most and out < quality_rules.CHUNK_SHARE and not far))
        assert (r.ratio, r.chunks_out, r.chunk_far, r.kept) in wants
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(r.doc_id for r in got if r.kept)
    assert quality_rules.keep(empty).count() == 0
    assert quality_rules.assess(empty).count() == 0


@pytest.mark.parametrize("size", [600, 1200, 3000, 4000, 6500])
def test_quality_rules_partial_junk(spark, sf_dir, size):
    """Clean text stays; the same text with 30 % random printable characters behind it goes."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").join(spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1 AND toxic = 0"), "doc_id")
    clean = [r.text[:size] for r in d.filter(F.length("text") >= size).orderBy("doc_id").collect()]
    r = random.Random(size)
    junk = [t + " " + "".join(chr(r.randint(33, 126)) for _ in range(size * 3 // 10)) for t in clean]
    got = quality_rules.assess(spark.createDataFrame([(i, t) for i, t in enumerate(clean + junk)], "doc_id long, text string")).collect()
    assert clean and all(x.kept or x.base_failed for x in got if x.doc_id < len(clean))
    assert not any(x.kept for x in got if x.doc_id >= len(clean))


@pytest.mark.parametrize("lang", ["en", "de", "fr", "es"])
def test_quality_rules_junk_chunks(spark, lang):
    """One or two chunks of 2 KB of junk, on a border of chunks or off it, in texts of 3 to 60 KB."""
    sf = "/root/testdata/sf0.1"
    d = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1 AND toxic = 0"), "doc_id").filter((F.col("lang") == lang) & (F.length("text") > 1000))
    base = [r.text.encode() for r in d.orderBy("doc_id").limit(200).collect()]
    r = random.Random(lang)
    clean, junked = [], []
    for size in (3000, 6500, 15_000, 30_000, 60_000):
        for n in (1, 2):
            for border in (True, False):
                t = b""
                while len(t) < size:
                    t += r.choice(base) + b"\n"
                t = t[:size].decode("utf-8", "ignore")
                at = r.randrange(0, size - 2048, 2048) + (1024 if border else 0)
                junk = "".join(chr(r.randint(33, 126)) for _ in range(2048 * n))
                clean.append(t)
                junked.append(t[:at] + " " + junk + " " + t[at:])
    got = {x.doc_id: x.kept for x in quality_rules.assess(spark.createDataFrame(list(enumerate(clean + junked)), "doc_id long, text string")).collect()}
    assert not any(got[len(clean) + i] for i in range(len(junked)))
    assert all(got[i] for i in range(4))  # longer ones repeat whole documents


def test_lm_scoring(docs, rows, empty):
    """Against a plain walk with back-off, token by token; and runs of any length carry the same state."""
    tokens = [(i, [x.lower() for x in split(t)] + [1]) for i, t, *_ in rows]
    out = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    c, b, d = collections.Counter(), collections.Counter(), collections.Counter()
    for i, w in tokens:
        if not out(i):
            c.update(w)
            b.update(zip([1, *w], w))
            d.update(zip([1, *w], w, w[1:]))
    n, v, m2, m3 = sum(c.values()), len(c), lm_scoring.MU2, lm_scoring.MU3
    p = lambda x: (c[x] + 0.5) / (n + 0.5 * (v + 1))

    def walk(w):
        total, state = 0.0, (1,) if c[1] else ()
        for x in w:
            while True:
                if len(state) == 2:
                    count, of, m = d[(*state, x)], b[state], m3
                elif state:
                    count, of, m = b[(*state, x)], c[state[0]], m2
                else:
                    total += math.log10(p(x))
                    state = (x,) if c[x] else ()
                    break
                if count:
                    two = (b[state[-1], x] + m2 * p(x)) / (c[state[-1]] + m2)
                    total += math.log10(two if len(state) == 1 else (count + m3 * two) / (of + m3))
                    state = (state[-1], x) if b[state[-1], x] >= lm_scoring.LEAST else (x,)
                    break
                total += math.log10(m / (of + m))
                state = state[1:]
        return total

    want = sorted((str(i), out(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10(p(x)) for x in w), walk(w)) for i, w in tokens)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm_scoring.score(docs).collect())
    for a, e in zip(got, want, strict=True):
        assert a[:5] == e[:5] and a[5:] == pytest.approx(e[5:], rel=1e-9)
    assert lm_scoring.score(empty).count() == 0


def test_automaton_runs():
    r = np.random.default_rng(1)
    t = lm_scoring.Tokens([b" ".join(b"w%d" % x for x in r.integers(0, 40, k)) for k in (3000, 0, 1, 2, 255, 700)])
    words, pairs = r.integers(0, 9, len(t.word_keys)) * 100.0, r.integers(0, 4, len(t.pair_keys)) * 1.0
    a, b = t.pair_words
    pairs[(words[a] == 0) | (words[b] == 0)] = 0
    t.triples(pairs >= 2)
    triples = np.minimum(r.integers(0, 3, len(t.triple_keys)), pairs[t.triple_pair])
    triples[pairs[np.lexsort((b, a))][np.searchsorted(np.sort(a * len(words) + b), b[t.triple_pair] * len(words) + t.triple_word)] == 0] = 0
    m = lm_scoring.Automaton(t, words, pairs, triples, 1000, 50, 300.0, 20.0, 2)
    whole = m.walk(t, 1 << 20)
    for run in (3, 64, 256):
        assert np.allclose(m.walk(t, run), whole, rtol=0, atol=1e-12)


def test_fingerprints(spark, docs, rows, empty):
    """Next documents, edited texts and, from the hashes in each fingerprint, every estimate; ids spread evenly, heaped and one."""
    for kw in ({"parts": 1}, {"parts": 5}, {"parts": 40}):
        got = fingerprints.fingerprint_pairs(docs, **kw).collect()
        assert len(got) == len(rows)
        order = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0])
        by = collections.defaultdict(set)
        for k, (i, t, *_) in enumerate(order):
            after = ((order[k + 1][1] if k + 1 < len(order) else rows[-2][1]) or "")  # the row without an id comes last
            t = t or ""
            by[i].add(hashlib.sha256((t[: len(t) - len(t) // 3] + after[: len(t) // 3]).encode()).hexdigest())
        t, after = rows[-2][1], order[0][1] or ""
        by[None].add(hashlib.sha256((t[: len(t) - len(t) // 3] + after[: len(t) // 3]).encode()).hexdigest())
        for r in got:
            assert r.edited_sha256 in by[r.doc_id]
    text = {i: t or "" for i, t, *_ in rows}
    prints = {r.doc_id: r.fingerprint for r in got}
    assert len({(*split(text[i]), f) for i, f in prints.items()}) == len({tuple(split(text[i])) for i in prints}) == len(set(prints.values()))
    times = collections.Counter(r[0] for r in order)
    follows = {a[0]: b[0] for a, b in zip(order, order[1:]) if times[a[0]] == 1}
    for r in got:
        a, b, c = (f.split() for f in (r.fingerprint, r.edited_fingerprint, prints[follows.get(r.doc_id, r.doc_id)]))
        for other, near, inside in ((b, r.near_edited, r.contained_edited), *([(c, r.near_next, r.contained_next)] if r.doc_id in follows else [])):
            x, y = set(a[1:]), set(other[1:])
            assert near == (1.0 if a[0] == other[0] else len(x & y) / len(x | y) if x | y else 0.0)
            assert inside == (1.0 if a[0] == other[0] else len(x & y) / len(x) if x else 0.0)
    heaped = [(7, f"hot {i}", *rows[0][2:]) for i in range(300)] + [(i * 1000, f"t{i}", *rows[0][2:]) for i in range(30)] + [(None, f"n{i}", *rows[0][2:]) for i in range(50)]
    out = fingerprints.with_next(spark.createDataFrame(heaped, SCHEMA), "doc_id", "text", 60).select("id", "text", "next_text").collect()
    after = {r.text: r.next_text for r in out}
    seen, at, chain = set(), heaped[329][1], []
    while at not in seen:
        seen.add(at)
        chain.append(at)
        at = after[at]
    assert len(chain) == len(out) == len(heaped)  # one ring through all rows, in descending id
    ids = {t: i for i, t, *_ in heaped}
    key = [-math.inf if ids[t] is None else ids[t] for t in chain]
    assert key == sorted(key, reverse=True)
    assert fingerprints.fingerprint_pairs(empty).count() == 0


def test_fingerprints_estimate(spark):
    """Against exact resemblance and containment, of texts of unequal length too; merged sketches are sketches of both texts."""
    r = random.Random(4)
    words_ = [f"w{r.randint(0, 10**6)}" for _ in range(6000)]
    pairs = [(words_[:4000], words_[1000:5000]), (words_[:400], words_[:5000]), (words_[:3000], words_[3000:])]
    d = spark.createDataFrame([(i, " ".join(a), " ".join(b), " ".join(a + b[:4]) if i == 2 else "") for i, (a, b) in enumerate(pairs)], "i int, a string, b string, c string")
    for c in "abc":
        d = fingerprints.with_sketch(d, c, f"s{c}")
    a, b = F.col("sa"), F.col("sb")
    got = d.select("i", fingerprints.likeness(a, b).alias("near"), fingerprints.containment(a, b).alias("inside"), fingerprints.merge(a, b)["kept"].alias("m"), "sa.kept", F.col("sb.kept").alias("b")).orderBy("i").collect()
    for row, (x, y) in zip(got, pairs):
        x, y = ({tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (x, y))
        assert row.near == pytest.approx(len(x & y) / len(x | y), abs=0.06) and row.inside == pytest.approx(len(x & y) / len(x), abs=0.06)
        assert row.m == sorted(set(row.kept) | set(row.b)) and len(row.kept) * fingerprints.SCALE == pytest.approx(len(x), rel=0.3)


def test_quality_lm(spark, docs, rows, empty):
    """Perplexities, limits and verdicts against a plain implementation of the same interpolated model."""
    top = quality_lm.ORDER
    labels = spark.createDataFrame([(i, 1 if n % 5 else 0, None) for n, (i, *_) in enumerate(rows) if i is not None], "doc_id long, quality int, toxic int")
    held = {r.doc_id: r.held for r in quality_lm.trusted_ids(labels, "doc_id").collect()}
    fitted = {i for i, h in held.items() if not h}

    def events(t):
        s = b" " + b" ".join(split(t)) + b" "
        return [[s[j + 1 - k : j + 1] for k in range(1, min(j + 1, top) + 1)] for j in range(1, len(s))] if len(s) > 2 else []

    raw = collections.defaultdict(collections.Counter)
    for i, t, lang, *_ in rows:
        if i in fitted:
            raw[lang or ""].update(e[-1] for e in events(t))
    models, sums = {}, {}
    for lang, c in raw.items():
        level, above = {}, None
        for k in range(top, 0, -1):
            n = collections.Counter({g: x for g, x in c.items() if len(g) == k})
            if above is not None:
                n.update(collections.Counter(g[1:] for g in above))
            level[k] = above = n
            of = collections.Counter(n.values())
            y = of[1] / (of[1] + 2 * of[2]) if of[1] + 2 * of[2] else 0.5
            d = [max(0.05, min(i - 0.05, i - (i + 1) * y * (of[i + 1] / of[i] if of[i] else 0.5))) for i in (1, 2, 3)]
            for g, x in n.items():
                s = sums.setdefault((lang, k, g[:-1]), [0, 0.0, {}])
                s[0] += x
                s[1] += min(x, d[min(x, 3) - 1])
                s[2][g] = max(x - min(x, d[min(x, 3) - 1]), 0)
        models[lang] = level

    def weights(t, lang):
        out = []
        for e in events(t):
            p = 1 / 257
            for k, g in enumerate(e, 1):
                if s := sums.get((lang, k, g[:-1])):
                    p = s[2].get(g, 0) / s[0] + s[1] / s[0] * p
            out.append(-math.log(p))
        return out

    def worst(t, w):
        out, at = [], 0
        for x in split(t):
            out.append(sum(w[at : at + len(x) + 1]) / (len(x) + 1))
            at += len(x) + 1
        return max(out)

    want = []
    for i, t, lang, *_ in rows:
        w = weights(t, lang or "") if (lang or "") in models else []
        want.append((str(i), len(w), sum(w) / len(w) if w else -1.0, worst(t, w) if w else -1.0))
    got = quality_lm.classify(docs, labels).collect()
    for a, e in zip(sorted((str(r.doc_id), r.n_bytes, -1.0 if r.log_ppl is None else r.log_ppl, -1.0 if r.worst_word is None else r.worst_word) for r in got), sorted(want), strict=True):
        assert a[:2] == e[:2] and a[2:] == pytest.approx(e[2:], rel=1e-3, abs=3e-4)  # weights travel as 16 bits
    by_lang = collections.defaultdict(lambda: ([], []))
    for r in got:
        if r.doc_id in held and r.log_ppl is not None:
            by_lang[r.lang or ""][held[r.doc_id]].append(r.score)
    for r in got:
        if r.log_ppl is not None:
            assert r.score == pytest.approx(r.log_ppl - quality_lm.SHORT / math.sqrt(r.n_bytes))
            fit, out = by_lang[r.lang or ""]
            assert len(out) < quality_lm.LEAST_HELD and r.limit == pytest.approx(max(max(out, default=-9), max(fit) + quality_lm.LEAVE))
            assert r.kept == (r.score <= r.limit and r.worst_word <= r.word_limit)
        else:
            assert r.kept
    kept = quality_lm.keep(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in got if r.kept)
    assert quality_lm.classify(empty, labels).count() == 0 and quality_lm.keep(empty, labels).count() == 0
    assert quality_lm.keep(docs, labels.limit(0)).count() == len(rows)


def test_quality_lm_word_order():
    """Context goes across words, so their order counts."""
    a, b = (quality_lm.Grams([t], np.array([0])) for t in (b"alpha beta gamma beta", b"beta gamma beta alpha"))
    assert set(a.keys.tolist()) != set(b.keys.tolist())


def test_quality_lm_single_words(spark):
    """A bad word in a long good text, and labelled junk, go; good text the model has not seen stays."""
    r = random.Random(8)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    text = lambda: " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(300))
    good = [text() for _ in range(400)]
    toxic = [f"{t[:700]} scum {t[700:]}" for t in (text() for _ in range(40))]
    junk = ["".join(r.choice("qxzjkvw ") for _ in range(1500)) for _ in range(20)]
    rows = list(enumerate(good + toxic + junk))
    d = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, int(i < 440), int(400 <= i < 440)) for i, _ in rows if i < 200 or i >= 400], "doc_id long, quality int, toxic int")
    gone = {x.doc_id for x in quality_lm.classify(d, labels).filter("NOT kept").collect()}
    assert len([i for i in gone if i < 400]) <= 20
    assert len([i for i in gone if 400 <= i < 440]) >= 36
    assert len([i for i in gone if i >= 440]) == 20


def test_pipeline_stages(spark, sf_dir):
    corpus_pipeline = pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns and out.dtypes == docs.dtypes
            assert out.count() <= n
            n, docs = out.count(), out
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = labels.filter("quality = 1 AND toxic = 0").select("doc_id")
    rules = quality_rules.assess(spark.read.parquet(f"{sf_dir}/documents.parquet").join(clean, "doc_id"))
    assert rules.filter("NOT base_failed AND NOT kept").count() == 0
    assert out.select(F.countDistinct("sequence_id")).first()[0] <= 1.05 * out.agg(F.ceil(F.sum("length") / 1024)).first()[0]


def test_pipeline_edge_rows(spark, sf_dir, rows):
    """Nulls, empty and long texts, repeats, one id with two texts, clashing columns and empty tables, in every stage."""
    r = random.Random(1)
    a, b, c = (" ".join(r.choice(rows[k][1].split()) for _ in range(80)) for k in (0, 20, 40))
    long = " ".join(f"{x}{i}" for i, x in enumerate(a.split() * 700))
    hand = [(3, a), (5, a), (5, b), (5, b), (None, a), (None, None), (7, None), (8, ""), (9, " \n "), (10, c), (11, long), (12, c + " tail")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, unit_id string, rows int, kept string, n_words string, nth string, answers int, picks string"
    docs = spark.createDataFrame([(i, t, ["en", None][k % 2], None, None, "u", 1, None, "w", "n", 2, "p") for k, (i, t) in enumerate(hand)], schema).repartition(2)
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        got = out.collect()
        if name == "best-fit packing":
            assert sum(x.piece == 0 for x in got) == len(hand)
        else:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert all((x.unit_id, x.rows, x.n_words, x.answers, x.picks) == ("u", 1, "w", 2, "p") for x in got)
        if name == "near dedup":
            assert collections.Counter((x.doc_id, x.text) for x in got) == collections.Counter([(3, a), (5, b), (None, a), (None, None), (7, None), (8, ""), (9, " \n "), (10, c), (11, long)])
        if name == "substring dedup":
            assert len(got) == len(hand) and all(x.n_chars == len(x.text) for x in got)
            assert sorted(x.text for x in got if x.doc_id == 5) == sorted(["", b, b])
            assert [x.text for x in got if x.doc_id == 12] == ["tail"]
        if name == "quality rules":
            assert not any(x.text is None or len(x.text.split()) < 10 for x in got)
        if name == "quality classifier":
            assert sum(x.text is None or not x.text.strip() for x in got) == 4
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_near_dedup_link_recall(spark, sf_dir):
    """Of the links that brute force finds between some documents and all, those whose ends share a component."""
    found, missed = link_recall(spark, sf_dir, 1)
    assert found and not missed


def link_recall(spark, sf_dir, every=50):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    component = {r.doc_id: r.component_id for r in queries.op1_near_dedup(spark, sf_dir).collect()}
    sets, posting = {}, collections.defaultdict(list)
    for r in rows:
        w = (r.text or "").encode().lower().split()
        sets[r.doc_id] = {hash(tuple(w[j : j + 4])) for j in range(max(1, len(w) - 3))} if w else set()
        for g in sets[r.doc_id]:
            posting[g].append(r.doc_id)
    found = missed = 0
    for i in (i for i in sets if i % every == 0):
        shared = collections.Counter(j for g in sets[i] for j in posting[g])
        for j, n in shared.items():
            if j != i and 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                found += 1
                missed += component[i] != component[j]
    return found, missed
