import numpy as np
import xxhash
from pyspark.sql import functions as F

from helioquery.llm import components
from helioquery.llm.components import connected_components
from helioquery.llm.simhash import drop_near_copies, fingerprint, simhash_components
from helioquery.llm.simhash import close_links
from helioquery.llm.vectors import embedding_components

SF = "/root/testdata/sf0.01"


def groups(n, links):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components_of_path_star_and_cycle(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300), (None, 5)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200, 202: 200}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = sorted(texts)
    fps = [slow_fingerprint(texts[i]) for i in ids]
    links = [(i, j) for i in range(len(ids)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    roots = groups(len(ids), links)
    want = {ids[i]: (f"{fps[i]:016x}", ids[roots[i]]) for i in range(len(ids))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_components(docs).collect()}
    assert got == want
    assert drop_near_copies(docs).count() == len({v[1] for v in want.values()})


def test_simhash_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (5, "one TWO"), (None, "x y z w"), (7, "word " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x"))
    got = sorted((r["doc_id"] or 0, r["fingerprint"] == "0" * 16, r["component_id"]) for r in simhash_components(docs).collect())
    assert got == [(0, False, None), (1, True, 1), (2, True, 1), (3, True, 1), (4, False, 4), (5, False, 4), (5, False, 4), (7, False, 7)]
    assert sorted(r["doc_id"] or 0 for r in drop_near_copies(docs).collect()) == [0, 1, 4, 7]
    assert simhash_components(docs.limit(0)).count() == 0
    assert fingerprint("Ä b") != fingerprint("ä b") and fingerprint("A b") == fingerprint("a\u000bb")


def test_simhash_large_bucket_is_cut_into_cells(spark):
    rng = np.random.default_rng(1)
    base = rng.permutation(3000).tolist()
    rows = [(i, " ".join(map(str, base)) + f" {i}") for i in range(2500)]
    got = simhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    fps = [int(r["fingerprint"], 16) for r in sorted(got, key=lambda r: r["doc_id"])]
    seen = sorted(set(fps))
    arr = np.array(seen, dtype=np.uint64)
    links = [(i, j) for i in range(len(arr)) for j in np.flatnonzero(np.bitwise_count(arr[:i] ^ arr[i]) <= 3).tolist()]
    roots = groups(len(arr), links)
    label = {f: roots[k] for k, f in enumerate(seen)}
    first = {}
    for i, f in enumerate(fps):
        first.setdefault(label[f], i)
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: first[label[f]] for i, f in enumerate(fps)}


def brute_vectors(rows, threshold=0.98):
    able = [v is not None and lab is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    unit = [np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if ok else None for (_, v, _), ok in zip(rows, able)]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if able[i] and able[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]
    count = [0] * len(rows)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    roots = groups(len(rows), links)
    return {rows[i][0]: (count[i], rows[roots[i]][0], roots[i] == i) for i in range(len(rows))}


def test_embeddings_equal_brute_force(spark):
    data = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in data.orderBy("vec_id").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_components(data).collect()}
    assert got == brute_vectors(rows)


def test_embeddings_large_group_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(8)
    rows = [(i, [float(np.float32(x)) for x in base + rng.standard_normal(8) * 0.02], 1) for i in range(2300)]
    rows += [(5000, None, 1), (5001, [0.0] * 8, 1), (5002, [float("nan")] * 8, 1), (5003, [None] + [1.0] * 7, 1), (5004, [], 1), (5005, rows[0][1], None), (5006, rows[0][1], 2), (5007, [1.0, 2.0], 1), (5008, [2.0, 4.0], 1), (5009, rows[1][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("cid", F.lit(0)).withColumn("kept", F.lit("x"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_components(df).collect()}
    assert got == brute_vectors(rows)
    assert embedding_components(df.limit(0)).count() == 0


def test_simhash_counts_the_top_bit(spark):
    base = 0x0123456789ABCDEF
    marks = [base, base ^ (1 << 63 | 1 << 5 | 1 << 40), base ^ 0xFFFF0000FFFF0000]
    fps = [(int(np.uint64(x).astype(np.int64)),) for x in marks]
    got = [tuple(sorted(r)) for r in close_links(spark.createDataFrame(fps, "fp long")).collect()]
    assert set(got) == {tuple(sorted((fps[0][0], fps[1][0])))}


def test_components_of_one_task_equal_those_of_rounds(spark, monkeypatch):
    rng = np.random.default_rng(5)
    nodes = rng.integers(-(1 << 62), 1 << 62, 400)
    links = [(int(a), int(b)) for a, b in nodes[rng.integers(0, 400, (220, 2))]]
    links += [(9 * k, 9 * k + 9) for k in range(60)] + [(7, 7), (None, 4)] + links[:20]
    up = {x: x for x in sorted({x for a, b in links if a is not None and a != b for x in (a, b)})}
    while any(up[a] != up[b] for a, b in links if a in up and b in up):
        for a, b in links:
            if a in up and b in up:
                up[a] = up[b] = min(up[a], up[b])
    frame = spark.createDataFrame(links, "src long, dst long").repartition(5)
    jobs = spark.sparkContext.statusTracker()
    took = {}
    for most in (components.ONE_TASK, 0):
        monkeypatch.setattr(components, "ONE_TASK", most)
        spark.sparkContext.setJobGroup(f"components {most}", "")
        assert {r["node"]: r["root"] for r in components.connected_components(frame).collect()} == up
        took[most] = len(jobs.getJobIdsForGroup(f"components {most}"))
    spark.sparkContext._jsc.clearJobGroup()
    assert max(took.values()) > 2 * min(took.values())  # the driver plans no rounds for few links
