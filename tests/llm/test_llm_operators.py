"""The corpus operators against plain versions, on edge rows and on the given tables."""

import base64
import hashlib
import random
import zlib

import compare
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from mediacurate.llm import (
    decontaminate,
    exact_dedup,
    graph,
    jaccard_join,
    line_dedup,
    mixing,
    oracle,
    quality,
    queries,
    simhash,
    suffix_dedup,
    token_records,
    toxicity,
    warc,
)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, block string, _row int, fp string"
WHITE = " \t\n\x0b\x0c\r"


def edge_rows():
    draw = random.Random(5)
    words = ["alpha", "Beta", "gamma", "délta", "ẞ", "é", "x1", "'s", "<|endoftext|>", " ", "日本語", "it's", "áb"]
    prose = [" ".join(draw.choice(words) for _ in range(n)) for n in (3, 12, 40, 200, 3000)]
    shared = "A passage that is the same in several documents and is longer than fifty bytes by far."
    texts = [
        None, "", " \t\n", "one", "a b", "a b\n", *prose, prose[2], prose[2] + " end", prose[3].replace("alpha", "Alpha", 1),
        shared, "x " + shared + " y", shared + "\n" + shared, "  " + shared.upper() + "\t\n tail\n\n", "ab" * 400, "ab" * 400, "a" * 120,
        "line one of some length\nline two of some length\nshort", "LINE ONE of some length \nother line of length\nshort",
        "\r\nline one of some length\r\n", "0123456789\n0123456789", "é" * 9 + "\n" + "é" * 10, "é" * 10, "word " * 20000,
    ]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else f"s{i % 4}", None, "b", 1, None) for i, t in enumerate(texts)]
    rows.append((3, "one", None, None, None, None, None, "x"))  # a repeated row
    rows.append((None, prose[2], None, "s1", None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None))
    draw.shuffle(rows)
    return rows


ROWS = edge_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(4)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def order_of(row_id):
    return (row_id is None, row_id or 0)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# --- queries beside their SQL ------------------------------------------------------


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    df, db = queries.QUERIES[name](spark, sf_dir), compare.connect(sf_dir)
    assert compare.types_differ(df, db, oracle.ORACLE[name]) == []
    assert compare.spark_rows(df) == compare.duck_rows(db, oracle.ORACLE[name])


def test_all_are_registered():
    import __spark_entry__ as contract

    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(oracle.ORACLE) <= set(contract.oracle_sql())
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]


# --- 1 -------------------------------------------------------------------------------


def encoded(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, queries.END_ID] for t in texts]


def plain_tokens(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    out, start = [], 0
    for row, ids in zip(ordered, encoded([r[1] for r in ordered]), strict=True):
        out.append((row[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_token_records(spark, docs, nothing):
    columns = ("doc_id", "start", "n_tokens", "ids_crc32")
    made = token_records.tokenized(docs, queries.tokenizer_path(), queries.END_ID, file_bytes=2000)
    assert got(made, *columns) == plain_tokens(ROWS)
    assert token_records.tokenized(nothing, queries.tokenizer_path(), queries.END_ID).count() == 0


def test_token_query_on_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert got(queries.op1_token_records(spark, sf_dir), "doc_id", "start", "n_tokens", "ids_crc32") == plain_tokens(rows)


def test_records_are_found_by_offset_and_damage_is_seen(spark, docs, tmp_path):
    manifest = token_records.write_records(docs, queries.tokenizer_path(), queries.END_ID, f"file://{tmp_path}/out").collect()
    assert sum(m.records for m in manifest) == len(ROWS)
    file = max(manifest, key=lambda m: m.records).file
    whole = list(token_records.records(file))
    for at in reversed(range(len(whole))):
        row_id, ids = token_records.record_at(file, token_records.offsets(file)[at])
        assert row_id == whole[at][0] and ids.tolist() == whole[at][1].tolist()
    path = file.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(ValueError):
        list(token_records.records(file))


def test_words_of_a_text_are_its_encoding():
    draw = random.Random(11)
    alphabet = list("aA bB\n\t́é'sß1ﬁ<|>  \x1c\x85İΣς日 ") + ["<|endoftext|>", "'ll", " \n"]
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60))) for _ in range(400)]
    from pathlib import Path

    encoder = token_records.WordEncoder(Path(queries.tokenizer_path()).read_text(), by_word=True)
    for text, ids in zip(texts, encoded(texts), strict=True):
        assert np.frombuffer(encoder.of(text, queries.END_ID), "<u2").tolist() == ids


def test_words_are_encoded_apart_only_where_the_tokenizer_parts_them():
    import json
    from pathlib import Path

    told = Path(queries.tokenizer_path()).read_text()
    assert token_records.words_apart(told)
    other = json.loads(told)
    other["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    assert not token_records.words_apart(json.dumps(other))
    whole = token_records.WordEncoder(json.dumps(other), by_word=False)
    from tokenizers import Tokenizer

    for text in ("two  words\n and more", ""):
        want = Tokenizer.from_str(json.dumps(other)).encode(text, add_special_tokens=False).ids
        assert np.frombuffer(whole.of(text, 2), "<u2").tolist() == [*want, 2]


def test_every_file_is_read_by_a_task_of_its_own(spark, docs):
    manifest = token_records.write_records(docs, queries.tokenizer_path(), queries.END_ID, token_records.scratch_path(spark, "records"), file_bytes=100)
    tasks = token_records.read_records(spark, manifest).select(F.spark_partition_id().alias("task"), "record")
    files = manifest.count()
    found = manifest.repartitionByRange(files, "file").select(F.spark_partition_id().alias("task")).distinct().count()
    assert files > 8 and found == files and tasks.count() == len(ROWS)


# --- 2 -------------------------------------------------------------------------------


def plain_suffix(rows, length=50):
    first = {}
    for row in sorted(rows, key=lambda r: order_of(r[0])):
        body = (row[1] or "").encode()
        for i in range(len(body) - length + 1):
            first.setdefault(body[i : i + length], order_of(row[0]))
    out = []
    for row in rows:
        body = (row[1] or "").encode()
        gone = np.zeros(len(body) + 1, bool)
        for i in range(len(body) - length + 1):
            if first[body[i : i + length]] < order_of(row[0]):
                gone[i : i + length] = True
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])
        kept = bytes(c for c, g in zip(body, gone, strict=False) if not g)
        out.append((row[0], len(body), int(gone.sum()), spans, sha(kept)))
    return sorted(out, key=repr)


SUFFIX = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("block_bytes", [500, 1 << 20])
def test_suffix_dedup(docs, nothing, block_bytes):
    made = suffix_dedup.suffix_dedup(docs, block_bytes=block_bytes, bucket_hashes=50, bucket_windows=300, keep_text=True)
    assert got(made, *SUFFIX) == plain_suffix(ROWS)
    assert all(sha(bytes(r.kept)) == r.kept_sha256 for r in made.collect())
    assert suffix_dedup.suffix_dedup(nothing).count() == 0


def test_suffix_query_on_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert got(queries.op2_suffix_dedup(spark, sf_dir), *SUFFIX) == plain_suffix(rows)


def test_cover_has_every_distance():
    cover = suffix_dedup.COVER
    assert {(a - b) % suffix_dedup.PERIOD for a in cover for b in cover} == set(range(suffix_dedup.PERIOD))


def test_ties_of_windows_with_equal_ends():
    draw = random.Random(3)
    middle = ["m" * 18, "m" * 17 + "n", "n" + "m" * 17, "mmmmmmmmnmmmmmmmmm"]
    pieces = ["<" + "h" * 16 + draw.choice(middle) + "t" * 16 for _ in range(300)]
    text = np.frombuffer("".join(pieces).encode(), np.uint8)
    starts = np.arange(len(pieces)) * 51 + 1
    windows = [text[s : s + 50].tobytes() for s in starts]
    first = {w: i for i, w in reversed(list(enumerate(windows)))}
    assert suffix_dedup.sorted_classes(text, starts).tolist() == [first[w] for w in windows]


# --- 3 -------------------------------------------------------------------------------


def plain_lines(rows):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))

    holders = {}
    for row in rows:
        for line in (row[1] or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(order_of(row[0]))
    out = []
    for row in rows:
        lines = (row[1] or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == order_of(row[0])]
        out.append((row[0], len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


LINES = ("doc_id", "n_lines", "n_dropped", "kept_sha256")


@pytest.mark.parametrize("batches", [1, 3])
def test_line_dedup(docs, nothing, batches):
    assert got(line_dedup.line_dedup(docs, batches=batches, shards=4), *LINES) == plain_lines(ROWS)
    assert line_dedup.line_dedup(nothing).count() == 0


@pytest.mark.parametrize("batches", [1, 2])
def test_deletion_gives_what_insertion_of_the_rest_gives(spark, docs, batches):
    index = line_dedup.LineIndex(spark, shards=4)
    for n in range(batches):
        index.insert(docs.filter(F.coalesce("doc_id", F.lit(0)) % batches == n))
    gone = [r[0] for r in ROWS if r[0] is not None and r[0] % 4 == 1]
    index.delete(docs.filter("doc_id % 4 = 1"))
    rest = [r for r in ROWS if r[0] not in gone]
    assert got(index.deduplicated(docs.filter("doc_id IS NULL OR doc_id % 4 <> 1")), *LINES) == plain_lines(rest)
    index.insert(docs.filter("doc_id % 4 = 1"))  # and back again
    assert got(index.deduplicated(docs), *LINES) == plain_lines(ROWS)


def test_cuckoo_filter():
    draw = np.random.default_rng(1)
    k1, k2 = draw.integers(-(2**63), 2**63, (2, 50_000))
    held = line_dedup.CuckooFilter.of(k1, k2)
    assert held.has(k1, k2).all()
    other = draw.integers(-(2**63), 2**63, (2, 50_000))
    assert held.has(*other).mean() < 0.002
    again = line_dedup.CuckooFilter.load(held.dump())
    again.remove(k1[:20_000], k2[:20_000])
    assert again.has(k1[20_000:], k2[20_000:]).all() and again.has(k1[:20_000], k2[:20_000]).mean() < 0.01
    assert not line_dedup.CuckooFilter.of(k1[:0], k2[:0]).has(k1, k2).any()


# --- 4 -------------------------------------------------------------------------------


def test_exact_dedup(docs, nothing):
    groups = {}
    for r in ROWS:
        groups.setdefault("".join(c for c in r[1] or "" if c not in WHITE), []).append(r)
    want = []
    for content, members in groups.items():
        keep = min(members, key=lambda r: (-len(r[1] or ""), order_of(r[0])))[0]
        want += [(r[0], keep, len(members), r[0] == keep, sha(content)) for r in members]
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got(exact_dedup.exact_dedup(docs), *columns) == sorted(want, key=repr)
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_native_plans_have_no_python(spark, sf_dir):
    for name in ("op4_exact_dedup", "op8_decontaminate", "op9_mix"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


# --- 5 -------------------------------------------------------------------------------


def plain_fingerprint(text, size=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.translate(str.maketrans(WHITE, " " * 6)).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(values, distance=4):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in root:
        for b in root:
            if a < b and (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {v: find(v) for v in root}


def plain_groups(rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    roots = plain_components(set(prints))
    least = {}
    for r, p in zip(rows, prints, strict=True):
        if r[0] is not None:
            least[roots[p]] = min(r[0], least.get(roots[p], r[0]))
    return sorted(((r[0], f"{p:016x}", least.get(roots[p])) for r, p in zip(rows, prints, strict=True)), key=repr)


GROUPS = ("doc_id", "fingerprint", "component_id")


def test_near_groups(docs, nothing):
    assert got(simhash.near_groups(docs), *GROUPS) == plain_groups(ROWS)
    assert simhash.near_groups(nothing).count() == 0


def plain_kept(rows, size=5, percent=80):
    """The smallest id of each group of rows that similar shingles link; a group without an id keeps a null."""
    sets = []
    for r in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")
        words = [w for w in low.translate(str.maketrans(WHITE, " " * 6)).split(" ") if w]
        sets.append(frozenset(" ".join(words[at : at + size]) for at in range(max(1, len(words) - size + 1))) if words else frozenset())
    root = {s: s for s in sets}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    ordered = sorted(root, key=len)
    for place, a in enumerate(ordered):
        for b in ordered[place + 1 :]:
            if 100 * len(a) < percent * len(b):
                break
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                root[find(a)] = find(b)
    groups = {}
    for r, s in zip(rows, sets, strict=True):
        groups.setdefault(find(s), []).append(r[0])
    return sorted((min((i for i in ids if i is not None), default=None) for ids in groups.values()), key=repr)


@pytest.mark.parametrize("limits", [{}, {"tile_bytes": 4000, "tile_sets": 3}])
def test_near_dedup(docs, nothing, limits):
    kept = simhash.near_dedup(docs, **limits)
    assert kept.columns == docs.columns and simhash.near_dedup(nothing, **limits).count() == 0
    assert [i for (i,) in got(kept, "doc_id")] == plain_kept(ROWS)
    whole = {tuple(r) for r in kept.collect()}
    assert whole <= set(ROWS)


def test_near_dedup_of_edited_copies_and_a_passage_that_a_third_shares(spark):
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for n in [1, 4, 5, 8, 9, 10, 12, 15, 20, 30, 60, 150, 400, 1500] * 2:
        base = [draw.choice(vocabulary) for _ in range(n)]
        for _ in range(10):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, n // 25))):
                at = draw.randrange(len(copy))
                copy[at : at + draw.randint(0, 1)] = [draw.choice(vocabulary)] * draw.randint(0, 1)
                copy = copy or ["w"]
            texts.append(copy)
    shared = [draw.choice(vocabulary) for _ in range(60)]
    texts += [shared + [draw.choice(vocabulary) for _ in range(tail)] for tail in (3, 8, 14, 60) for _ in range(35)]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    draw.shuffle(rows)
    kept = simhash.near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert [i for (i,) in got(kept, "doc_id")] == plain_kept(rows)


def test_near_copies_of_every_size_share_a_block():
    draw, bands = random.Random(3), jaccard_join.Bands(simhash.PERCENT)
    found = pairs = 0
    for n in [20, 33, 60, 100, 150, 700] * 80:
        words, last = [str(draw.random()) for _ in range(n)], None
        edited = list(words)
        while True:  # as many replaced words as the similarity allows
            edited[draw.randrange(n)] = str(draw.random())
            a, b = (jaccard_join.set_of(" ".join(x), 5) for x in (words, edited))
            both = np.intersect1d(a, b).size
            if 100 * both < simhash.PERCENT * (len(a) + len(b) - both):
                break
            last = b
        if last is not None:
            pairs += 1
            near = (simhash.majority(a) ^ simhash.majority(last)).bit_count() <= simhash.NEAR_BITS
            found += near and np.intersect1d(simhash.blocks_of(a, bands), simhash.blocks_of(last, bands)).size > 0
    assert pairs > 250 and found >= 0.99 * pairs


def test_blocks_of_near_copies_are_cut_from_their_fingerprints():
    hashes = np.unique(np.random.default_rng(4).integers(0, 2**64, 21, dtype=np.uint64))
    bands = jaccard_join.Bands(simhash.PERCENT)
    whole = simhash.wide_fingerprint(hashes, 8)
    keys = simhash.blocks_of(hashes, bands, 8)
    assert np.array_equal(keys, simhash.block_keys(whole[None], 8)[0]) and len(np.unique(keys)) == simhash.block_count(8)
    assert np.array_equal(simhash.blocks_of(np.repeat(hashes, 3), bands), simhash.blocks_of(hashes, bands))  # one fingerprint
    changed = whole.copy()
    changed[0] ^= np.uint64(1)
    assert (simhash.block_keys(changed[None], 8)[0] != keys).tolist() == [True] + [False] * (len(keys) - 1)
    assert not simhash.blocks_of(hashes[:3], bands).size


@pytest.mark.parametrize("limit", [4, 40, 4096])
def test_close_wide_fingerprints_are_linked_however_large_their_groups(spark, limit):
    draw, bits = np.random.default_rng(limit), 4
    rows = []
    for centre in draw.integers(0, 2**64, (6, 3), dtype=np.uint64):
        for _ in range(40):
            change = np.packbits(draw.random(192) < draw.random() * 0.3).view(np.uint64)
            rows.append(centre ^ change)
    table = spark.createDataFrame([(i, r.view(np.int64).tolist()) for i, r in enumerate(rows)], "at bigint, prints array<bigint>")
    root = list(range(len(rows)))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    keys = simhash.block_keys(np.stack(rows), bits)
    for a in range(len(rows)):
        for b in range(a):
            if np.bitwise_count(rows[a] ^ rows[b]).sum() <= 3 * simhash.NEAR_BITS and (keys[a] == keys[b]).any():
                root[find(a)] = find(b)
    roots = {r.node: r.root for r in graph.components(simhash.near_links(table.repartition(3), bits, limit=limit)).collect()}
    pairs = {(find(v), roots.get(v, v)) for v in range(len(rows))}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_links_of_many_near_copies_are_few(spark):
    draw, bits, many = np.random.default_rng(6), 6, 600
    centre = draw.integers(0, 2**64, 3, dtype=np.uint64)
    rows = [centre ^ np.packbits(draw.random(192) < 0.06).view(np.uint64) for _ in range(many)]
    table = spark.createDataFrame([(i, r.view(np.int64).tolist()) for i, r in enumerate(rows)], "at bigint, prints array<bigint>")
    found = {(r.a, r.b) for r in simhash.near_links(table.repartition(3), bits).collect()}
    assert len(found) < 6 * many  # trees of blocks that know nothing of each other have some nine for each row
    assert len({at for pair in found for at in pair}) == many
    joined = graph.components(spark.createDataFrame(sorted(found), "a bigint, b bigint"))
    assert joined.select("root").distinct().count() == 1


def test_stars_connect_what_links_do():
    draw = np.random.default_rng(9)
    for many in (0, 1, 30, 400):
        a, b = draw.integers(0, 300, (2, many)) * 7
        hubs, others = simhash._stars(a, b)
        root = {int(v): int(v) for v in np.concatenate([a, b])}
        for _ in range(len(root)):
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                root[x] = root[y] = min(root[x], root[y])
        assert dict(zip(others.tolist(), hubs.tolist(), strict=True)) == {v: r for v, r in root.items() if v != r}


def test_near_query_on_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert got(queries.op5_simhash(spark, sf_dir), *GROUPS) == plain_groups(rows)


@pytest.mark.parametrize("limit", [4, 40, 4096])
def test_groups_beyond_the_limit_are_searched_by_finer_blocks(spark, limit):
    draw = random.Random(limit)
    values = set()
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(60):
            value = centre
            for bit in draw.sample(range(64), draw.randint(0, 4)):
                value ^= 1 << bit
            values.add(value)
    rows = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp bigint").repartition(3)
    roots = {r.node % 2**64: r.root for r in graph.components(simhash.links(rows, limit=limit)).collect()}
    want = plain_components(values)
    pairs = {(want[v], roots.get(v, v)) for v in values}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_fingerprints_that_differ_little_share_a_mask():
    draw = random.Random(2)
    for mask in (0, simhash.refine(0)[3], simhash.refine(simhash.refine(0)[3])[7]):
        finer = simhash.refine(mask)
        free = [b for b in range(64) if not mask >> b & 1]
        for _ in range(300):
            change = sum(1 << b for b in draw.sample(free, 4))
            assert any(not change & m for m in finer)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(300)]
    roots = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert len({roots[i] for i in range(301)}) == 1 and len({roots[i] for i in range(1000, 1301)}) == 1
    assert len(set(roots.values())) == 2


# --- 6 -------------------------------------------------------------------------------


PAGES = "page_id bigint, url string, html string, origin string, segment int"


def plain_pages(rows, least=0):
    largest = {}
    for page_id, html in rows:
        largest.setdefault(html or "", []).append(page_id)
    out = []
    for page_id, html in rows:
        body = (html or "").encode()
        ids = [i for i in largest[html or ""] if i is not None]
        top = max(ids) if ids else None
        again = len(body) >= least and page_id != top
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page_id, len(body), digest, "revisit" if again else "response", top if again else None))
    return sorted(out, key=repr)


WARC = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("least", [0, 30])
def test_warc_round_trip(spark, least):
    draw = random.Random(4)
    bodies = [None, "", "\r\n\r\n", "0\r\n\r\n", "WARC/1.1\r\nx: y", "é" * 9000, "<p>" + "z" * 40_000, "q" * 16_384] + [
        "".join(draw.choice("ab\r\n<é") for _ in range(draw.randint(1, 9000))) for _ in range(20)
    ]
    rows = [(i, "u", b, "o", 7) for i, b in enumerate(bodies)] + [(100 + i, None, b, None, None) for i, b in enumerate(bodies[::2])]
    rows += [(None, "u", bodies[7], "", 0), rows[-1]]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    made = warc.archived(spark, pages, least=least, segment=1000, file_bytes=20_000)
    assert got(made, *WARC) == plain_pages([(r[0], r[2]) for r in rows], least)
    assert made.filter("problem IS NOT NULL").count() == 0
    assert warc.archived(spark, spark.createDataFrame([], PAGES)).count() == 0


def test_warc_query_on_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "pages").select("page_id", "html").collect()]
    assert got(queries.op6_warc(spark, sf_dir), *WARC) == plain_pages(rows)


def test_missing_and_damaged_segments_are_reported(spark, tmp_path):
    body = ("<html>" + "x" * 5000).encode()
    parts = list(warc.page_records(1, body, None, "urn:a", 1000))
    damaged = [parts[0], parts[1].replace(b"xxxx", b"xxxy", 1), *parts[2:]]
    other = [p.replace(b"urn:a", b"urn:b") for p in parts]
    third = [p.replace(b"urn:a", b"urn:c") for p in damaged]
    kept = [*parts, *other[:2], *other[3:], *third, *(p.replace(b"urn:a", b"urn:d") for p in parts[1:])]
    draw = random.Random(1)
    draw.shuffle(kept)
    packed = b"".join((p := zlib.compressobj(4, zlib.DEFLATED, 31)).compress(record) + p.flush() for record in kept)
    (tmp_path / "one.warc.gz").write_bytes(packed)
    manifest = spark.createDataFrame([(f"file://{tmp_path}/one.warc.gz",)], "file string")
    found = sorted((r.problem or "", bytes(r.payload or b"")) for r in warc.read_warc(manifest).collect())
    assert found == [
        ("", body), ("digest differs", b""), ("segments missing or repeated", b""), ("segments missing or repeated", b""),
    ]


# --- 7 and 10 --------------------------------------------------------------------------


def judged(spark, scored, column, sf_dir):
    known = queries.table(spark, sf_dir, "labels").select("doc_id", F.col(column).alias("label"))
    rows = scored.join(known, "doc_id").filter("held_out").select("score", "predicted", "label").collect()
    good, bad = [r.score for r in rows if r.label == 1], [r.score for r in rows if r.label == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    return auc, np.mean([r.predicted == r.label for r in rows])


def test_toxicity_on_held_out_rows(spark):
    # Half of the toxic labels come with no word that is toxic for sure; the others are all but found.
    sf = "/root/testdata/sf0.1"
    scored = queries.op7_toxicity(spark, sf).cache()
    auc, accuracy = judged(spark, scored, "toxic", sf)
    assert auc > 0.88 and accuracy > 0.92
    ids = [r.doc_id for r in scored.filter("held_out").collect()]
    assert sorted(ids) == [i for i in range(10_000) if zlib.crc32(str(i).encode()) % 3 == 1]


def test_pipeline_drops_toxic_rows(spark):
    labels = queries.table(spark, "/root/testdata/sf0.01", "labels").select("doc_id", "toxic")
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    given = {r.doc_id: r.toxic for r in labels.collect()}
    toxic, clean = ({i for i, t in given.items() if t == mark} for mark in (1, 0))
    assert len(toxic - kept) >= 0.6 * len(toxic) and len(clean & kept) >= 0.98 * len(clean)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    auc, accuracy = judged(spark, queries.op10_quality(spark, sf), "quality", sf)
    assert auc > 0.9 and accuracy > 0.9


def test_the_whole_unlabelled_corpus_is_in_the_pool(spark, monkeypatch):
    known = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id bigint, quality int, toxic int")
    text = F.concat(F.when(F.col("id") % 2 == 1, "calm good words ").otherwise("bad worse words "), F.col("id"))
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    seen, train = [], quality.train
    monkeypatch.setattr(quality, "train", lambda learned, pool: seen.append(pool) or train(learned, pool, rounds=1))
    scored = quality.quality(docs, known)
    want = [i for i in range(60, 9000) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(want) > 5000 and sorted(r.doc_id for r in seen[0].select("doc_id").collect()) == want
    assert scored.count() == 9000


def test_features_are_packed_without_loss():
    draw = np.random.default_rng(2)
    for many in (0, 1, 5, 3000):
        places = np.sort(draw.choice(quality.BUCKETS, many, replace=False))
        counts = draw.integers(1, 2**32, many)
        found = quality._unpack(quality._packed(places, counts))
        assert np.array_equal(found[0], places) and np.array_equal(found[1], counts)
    text = "some words of a text that come again and again " * 40 + " ".join(f"w{i}" for i in range(500))
    places, counts = quality.TextView().counts(text)
    assert len(quality._packed(places, counts)) < 2 * len(places) and np.all(np.diff(places.astype(int)) > 0)


def test_chosen_rows_of_all_groups_count(spark):
    rows = [(i, "calm good words" if i % 2 else "bad worse words", "s", "en") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    free = frame.select("doc_id", (F.col("doc_id") * 1e-9).alias("order"), "text", "source", "lang").repartition(3)
    pool = quality._pool_features(free)
    labelled = [(r[1], r[2], r[3], r[0] % 2) for r in rows[:40]]
    models = [quality.train(labelled, pool, step=0.2, group=g) for g in (20, 20, 4000)]
    assert np.array_equal(models[0].words, models[1].words) and not np.array_equal(models[0].words, models[2].words)
    for m in models:
        good, bad = (m.score(quality.TextView().of(t), quality.metadata_of(t, "s", "en"))[1] for t in ("calm good words", "bad worse words"))
        assert good > 0.6 > 0.4 > bad


@pytest.mark.parametrize("known", [[], [(1, 1, 1)], [(1, None, None), (None, 1, 1), (2, 1, 0), (4, 0, 1), (6, 1, 0), (9, 0, 1)]])
def test_classifiers_on_edge_rows(spark, docs, nothing, known):
    labels = spark.createDataFrame(known, "doc_id bigint, quality int, toxic int")
    for scored in (toxicity.toxicity, quality.quality):
        rows = scored(docs, labels).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        assert scored(nothing, labels).count() == 0
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= len(ROWS)


def test_score_does_not_see_the_other_columns(spark, docs):
    labels = queries.table(spark, "/root/testdata/sf0.1", "labels")
    train = queries.table(spark, "/root/testdata/sf0.1", "documents")
    model = toxicity.fitted(train, labels, "text", "doc_id", "lang", "toxic", 2500)
    words, products = model.words(), model.products()
    assert model.score(words.of("You IDIOT"), products) == model.score(words.of("you idiot"), products)
    long = words.of("calm words " * 5000 + "idiot scum moron")
    assert model.score(long, products) > model.score(words.of("calm words " * 5000), products)


# --- 8 -------------------------------------------------------------------------------


def plain_hits(rows, items, window=13):
    import re

    def words(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    found = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            found.setdefault(tuple(w[i : i + n]), set()).update([] if item is None else [str(item)])
    out = []
    for r in rows:
        w, hit, ids = words(r[1]), set(), set()
        for n in {len(k) for k in found}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in found:
                    hit |= set(range(i, i + n))
                    ids |= found[k]
        out.append((r[0], len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


HITS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("limit", [0, 100_000])
def test_contamination(spark, docs, nothing, limit):
    texts = [r[1] for r in ROWS if r[1] and len(r[1]) > 60][:4]
    items = [(1, texts[0]), (2, "A passage, that is"), (3, "one"), (4, None), (5, "..."), (None, "SHORT"), (10, "word word"), (2, texts[1])]
    items.append((7, "a b"))
    benchmark = spark.createDataFrame([(i, t, "extra", "x") for i, t in items], "item_id bigint, text string, _words string, _doc string")
    made = decontaminate.contamination(docs, benchmark, broadcast_rows=limit)
    want = plain_hits(ROWS, items)
    assert got(made, *HITS) == want
    kept = decontaminate.without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(not w[-1] for w in want)
    assert decontaminate.contamination(nothing, benchmark).count() == 0
    assert got(decontaminate.contamination(docs, benchmark.limit(0)), *HITS) == plain_hits(ROWS, [])


# --- 9 -------------------------------------------------------------------------------


def test_mix_deviates_by_less_than_a_block(spark, docs, nothing):
    n = 4000
    rows = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
    )
    weights = {"hot": 0.5, "s0": 0.2, "s1": 0.1, "s2": 0.05}
    mixed = mixing.mix(rows, weights, block=4, frame=100).collect()
    assert len(mixed) == n and len({(r.slot, r.place) for r in mixed}) == n
    of_slot = {}
    for r in mixed:
        assert of_slot.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    counts, slots = {}, {}
    sizes = spark.createDataFrame([(f"={s}", 1) for s in {r.source for r in mixed}], "_source string, _rows bigint")
    shares = {r._source[1:]: r._slots / r._frame for r in mixing.source_shares(sizes, weights, 0.5, 100).collect()}
    assert abs(sum(shares.values()) - 1) < 1e-9 and abs(shares["hot"] - 0.5 / (0.85 + 4 * 0.05)) < 0.03
    totals = {s: sum(r.source == s for r in mixed) // 4 for s in shares}
    for t in range(1, max(of_slot) + 2):
        if t - 1 in of_slot:
            s = of_slot[t - 1][0]
            assert of_slot[t - 1][1] == counts.get(s, 0)  # blocks of a source in their order
            counts[s] = counts.get(s, 0) + 1
        live = [s for s in shares if shares[s] * t < totals[s] - 1]
        assert all(abs(counts.get(s, 0) - shares[s] * t) < 1 for s in live), t
        slots[t] = len(live)
    assert got(mixing.mix(docs, block=2), "doc_id") == sorted(((r[0],) for r in ROWS), key=repr)
    assert set(docs.columns) <= set(mixing.mix(docs).columns) and mixing.mix(nothing).count() == 0


@pytest.mark.parametrize("weights", [None, {"hot": 0.9, **{f"s{i}": 0.1 / 19 for i in range(19)}}])
def test_mix_keeps_to_the_target_weights_however_many_rows(spark, weights):
    n = 30_000
    name = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 19))
    rows = spark.range(n).select(F.col("id").alias("doc_id"), name.alias("source"))
    mixed = mixing.mix(rows, weights, block=4).collect()
    assert len(mixed) == n and len({(r.slot, r.place) for r in mixed}) == n
    sizes = {s: sum(r.source == s for r in mixed) for s in {r.source for r in mixed}}
    weight = {s: weights[s] if weights else many**0.5 for s, many in sizes.items()}
    target = {s: w / sum(weight.values()) for s, w in weight.items()}
    of_slot = {r.slot: (r.source, r.block) for r in mixed}
    assert len(of_slot) == sum(-(-many // 4) for many in sizes.values())
    had = dict.fromkeys(sizes, 0)
    for t in range(1, max(of_slot) + 2):
        if t - 1 in of_slot:
            s, number = of_slot[t - 1]
            assert number == had[s]
            had[s] += 1
        assert all(abs(had[s] - target[s] * t) < 1 + 1e-9 for s in sizes if had[s] < -(-sizes[s] // 4)), t


def test_schedule_comes_in_stretches_and_skips_what_nobody_asks_for():
    parts, blocks = [1, 10**9, 3], [3, 50, 0]
    whole = np.concatenate(list(mixing.whole_schedule(parts, blocks)))
    assert np.array_equal(whole, np.concatenate(list(mixing.whole_schedule(parts, blocks, stretch=7))))
    assert len(whole) == 53 and whole[:, 2].max() > 10**9 and np.all(np.diff(whole[:, 2]) > 0)
    assert list(mixing.whole_schedule([], [])) == []


# --- the pipeline ------------------------------------------------------------------------


def test_pipeline_stage_by_stage(spark, sf_dir, tmp_path):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, seen = given, {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir)
        if name != "token_records":
            assert made.columns == given.columns
        path = f"file://{tmp_path}/{name}"
        made.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        seen[name] = (before, docs)
    rows = {n: [tuple(r) for r in b.select("doc_id", "text", "source").collect()] for n, (b, _) in seen.items()}
    after = {n: [r.doc_id for r in a.select("doc_id").collect()] for n, (_, a) in seen.items()}
    model = toxicity.fitted(given, queries.table(spark, sf_dir, "labels"), "text", "doc_id", "lang", "toxic", toxicity.SAMPLE)
    words, products = model.words(), model.products()
    limit = toxicity.THRESHOLD if not model.thresholds else min(model.thresholds.values())
    clean = {r[0] for r in rows["toxicity"] if model.score(words.of(r[1]), products) < limit}
    assert clean <= set(after["toxicity"])
    assert sorted(after["near_dedup"], key=repr) == plain_kept(rows["near_dedup"])
    items = [tuple(r) for r in queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    assert sorted(after["decontamination"]) == sorted(h[0] for h in plain_hits(rows["decontamination"], items) if not h[-1])
    assert sorted(after["mixing"]) == sorted(after["decontamination"])
    assert sorted(after["token_records"]) == sorted(after["mixing"])
    mixed = mixing.mix(seen["mixing"][0].select("doc_id", "source")).orderBy("slot", "place").collect()
    written = seen["token_records"][1].orderBy("record").select("doc_id").collect()
    assert [r.doc_id for r in written] == [r.doc_id for r in mixed]
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(after["token_records"])


def test_pipeline_on_no_rows(spark, tmp_path):
    docs = spark.createDataFrame([], queries.TABLES["documents"])
    for name, stage in corpus_pipeline.STAGES:
        path = f"file://{tmp_path}/{name}"
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count() == 0
