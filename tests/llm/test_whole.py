"""The pipeline as a whole against brute force, base columns against SQL, and archives that are damaged."""

import collections
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from newsweft.llm import bpe, pipeline, quality_lm, quality_rules, queries, warc


def near_groups(rows, size=5):
    """Smallest id of each row's group: shingles of ``size`` words, 80 % shared, by all pairs."""
    sets = {}
    for i, t in rows:
        w = t.encode().lower().split()
        sets[i] = {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b]) if a < b else 0
            if n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}


def cut_repeats(rows):
    first = {}
    for i, t in rows:
        w = t.split()
        for j in range(len(w) - 12):
            k = tuple(w[j : j + 13])
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, t in rows:
        w = t.split()
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            if first[tuple(w[j : j + 13])] < i:
                gone[j : j + 13] = [True] * 13
        out[i] = " ".join(x for x, g in zip(w, gone) if not g)
    return out


def test_pipeline_composition(spark, sf_dir):
    """Every stage's decisions by brute force on what the stage before kept, and ``run`` gives the last stage's rows.

    The classifier's and the rules' verdicts are each row's own and are tested
    against plain versions by themselves; here they are taken from the operators.
    """
    from tokenizers import Tokenizer

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    likely = {r.doc_id for r in quality_lm.classify(documents, labels).filter("kept").collect()}
    good = {r.doc_id for r in quality_rules.assess(documents.select("doc_id", "text")).filter("kept").collect()}
    kept = [(i, t) for i, t in sorted(rows.items()) if i in likely and i in good]
    group = near_groups([(i, t) for i, t in kept])
    whole = cut_repeats([(i, t) for i, t in kept if group[i] == i])
    library = Tokenizer.from_file(bpe.default_tokenizer())
    want = {}
    for i, t in whole.items():
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        pieces = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        assert sum(map(len, pieces)) == len(ids)
        want[i] = ids

    texts = {}
    docs = documents
    for name, stage in pipeline.STAGES[:4]:
        docs = stage(spark, docs, sf_dir).cache()
        texts[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert set(texts["quality classifier"]) == likely and set(texts["quality rules"]) == likely & good
    assert set(texts["near dedup"]) == set(whole) and texts["substring dedup"] == whole

    got = collections.defaultdict(list)
    places = collections.defaultdict(list)
    out = pipeline.run(spark, sf_dir).collect()
    for r in out:
        got[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert set(got) == set(want)
    for i, ids in want.items():
        own = sorted(got[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        at = 0
        for r in own:
            part = ids[at : at + r.length]
            assert (r.start, r.ids_crc32) == (at, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)))
            assert r.length == 1024 or len(own) == 1 or r.piece == 0
            at += r.length
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(map(len, want.values()))
    assert len(places) <= 1.05 * -(-total // 1024) + 1


_WORD = r"[^\x20\x09-\x0D]+"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BASE = {
    "op8_quality_rules": rf"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
 g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
 twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
 rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) t(k) GROUP BY doc_id),
 lines AS (SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w) WHERE regexp_matches(l, '{_WORD}')),
 dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY doc_id)
 SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
 coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(w) < 10 OR 100 * coalesce(rep.n, 0) > 20 * len(w) AS base_failed
 FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)""",
    "op10_fingerprints": """SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(substr(t, 1, length(t) - length(t) // 3) || substr(coalesce(after, first), 1, length(t) // 3)) AS edited_sha256
 FROM (SELECT doc_id, coalesce(text, '') AS t, lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC) AS after, first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC) AS first FROM documents)""",
}


@pytest.mark.parametrize("name", sorted(BASE))
def test_base_columns(spark, sf_dir, name):
    """What needs no method of its own, over whole tables, by SQL."""
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    cur = con.execute(BASE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(map(tuple, queries.QUERIES[name](spark, sf_dir).select(*cols).collect())) == sorted(cur.fetchall())


def test_base_scores(spark, sf_dir):
    """op9's counts and base scores from plain counting; a sum's order isn't fixed, so to nine digits."""
    import math
    import re

    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    low = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    tokens = {i: [*re.findall(_WORD, t.translate(low)), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    c = collections.Counter(w for i, own in tokens.items() if not held[i] for w in own)
    n, v = sum(c.values()), len(c)
    for r in queries.op9_lm_scoring(spark, sf_dir).collect():
        own = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(c[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), rel=1e-9)


def damaged(spark, tmp_path, change, split=4096):
    r = random.Random(1)
    pages = spark.createDataFrame([(i, f"u{i}", "".join(r.choice("abcdefgh <>") for _ in range(r.randint(0, 3000)))) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_warc(pages, f"file://{tmp_path}/w")
    row = manifest.first()
    path = row.path.removeprefix("file://")
    with open(path, "rb") as f:
        data = f.read()
    starts = [i for i in range(len(data) - 2) if data[i : i + 3] == warc.MAGIC]
    new = change(bytearray(data), starts)
    with open(path, "wb") as f:
        f.write(new)
    there = spark.createDataFrame([(row.path, len(new), row.records)], manifest.schema)
    read = lambda strict: warc.read_warc(there, split=split, strict=strict).count()
    return read, row.records


def test_damaged_archives_fail(spark, tmp_path):
    def cut(data, starts):
        return data[: starts[-1] + 20]

    def hurt(place):
        def change(data, starts):
            data[starts[place] + 12 : starts[place] + 40] = b"\x00" * 28
            return data

        return change

    for k, change in enumerate((cut, hurt(0), hurt(7), hurt(30), hurt(-1))):
        read, records = damaged(spark, tmp_path / str(k), change)
        with pytest.raises(Exception, match="damaged or cut"):
            read(True)
        assert read(False) < records
    read, records = damaged(spark, tmp_path / "whole", lambda data, _: data, split=1000)
    assert read(True) == records


def test_hidden_columns(spark):
    """Clashing names of further columns."""
    pages = spark.createDataFrame([(1, "u", "x", "k", 2, "b"), (2, "u", "x", "k", 2, "b"), (3, None, None, None, None, None)], "page_id long, url string, html string, key string, salt int, body string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()}
    assert got == {1: ("response", None), 2: ("revisit", 1), 3: ("response", None)}
    assert warc.round_trip(pages.filter(F.lit(False))).count() == 0
