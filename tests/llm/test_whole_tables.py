"""Line dedup, the Merkle manifest and the filter audit against plain versions."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

import __spark_entry__ as contract
from tests.compare import check_engine, differences
from vitrine.llm import audit, linededup, merkle

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BLANK = " \t\n\x0b\f\r"


@pytest.mark.parametrize("name", ["op11_line_dedup", "op12_merkle_manifest", "op13_filter_audit"])
def test_same_rows_as_sql(spark, name):
    assert differences(contract.queries()[name](spark, SF), check_engine(SF), contract.oracle_sql()[name]) == ""


def multiset(rows):
    return collections.Counter(map(tuple, rows))


# --- lines


def lowered(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def plain_dedup(rows, least_length=40, least_documents=5):
    split = [(i, (t or "").split("\n")) for i, t in rows]
    held = collections.defaultdict(list)
    for i, lines in split:
        for key in {lowered(x.strip(BLANK)) for x in lines}:
            held[key].append(-1 if i is None else i)
    lost = {k: max(v) for k, v in held.items() if len(k) >= least_length and len(v) >= least_documents}
    out = []
    for i, lines in split:
        own = -1 if i is None else i
        kept = [x for x in lines if lost.get(lowered(x.strip(BLANK)), own) == own]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_lines_against_a_plain_version(spark):
    pick = random.Random(5)
    common = [f"{'ÄBC' if k % 3 else 'Abc'} line number {k} that several documents hold, ß É" for k in range(12)]
    short = ["", " ", "short", "Short \t", "x" * 39, "é" * 40, "\r", "É" * 40]
    rows = []
    for i in range(300):
        lines = [pick.choice(common if pick.random() < 0.5 else short) for _ in range(pick.randint(0, 12))]
        lines = [pick.choice(["", " ", "\t\x0b"]) + (x.upper() if pick.random() < 0.1 else x) + pick.choice(["", "\r"]) for x in lines]
        rows.append((i, "\n".join(lines)))
    rows += [rows[7]] * 3 + [(None, rows[8][1]), (None, common[0]), (400, None), (401, ""), (402, "\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for batches in (1, 3, 7):
        found = linededup.line_dedup(docs, batches=batches)
        assert multiset(found.collect()) == multiset(plain_dedup(rows)), batches
    found = linededup.line_dedup(docs, least_length=5, least_documents=2)
    assert multiset(found.collect()) == multiset(plain_dedup(rows, 5, 2))


def test_a_line_of_every_document_and_long_texts(spark):
    hot = "This boilerplate line stands in every document of the table."
    rows = [(i, f"{hot}\nown line of document {i} which is long enough to be counted") for i in range(3000)]
    rows.append((5000, "\n".join([hot] * 20_000) + "\n" + "x" * 300_000))
    found = {r.doc_id: r for r in linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[5000].n_dropped == 0 and all(found[i].n_dropped == 1 for i in range(3000))


def test_runs_share_no_hash_and_are_merged(spark):
    runs = linededup.LineRuns(spark)
    for b in range(5):
        runs.add(spark.createDataFrame([(k, -k, b) for k in range(b, b + 10)], "hi long, lo long, id long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = [r.hi for level in runs.levels for n in level for r in runs._run(n).collect()]
    assert sorted(held) == list(range(14))
    joined = runs._run(runs.levels[2][0]).join(runs._run(runs.levels[0][0]), ["hi", "lo"])._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in joined.split("== Physical Plan ==")[1]
    assert {(r.hi, r.docs, r.last) for r in runs.totals(5).collect()} == {(k, 5, 4) for k in range(4, 10)}
    runs.close()


# --- Merkle tree


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def digest(values):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_manifest(rows):
    by = collections.defaultdict(list)
    for i, text, lang, source, n in rows:
        leaf = digest([i, source, lang, n, text])
        hit = i is not None and zlib.crc32(str(i).encode()) % 7 == 0
        other = digest([i, source, lang, None if n is None else n + 1, text]) if hit else leaf
        by[lang].append((-(1 << 70) if i is None else i, leaf, other, i))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: plain_tree([x[1] for x in sorted(by[k])]) for k in langs}
    top = plain_tree([trees[k][-1][0] for k in langs]) if langs else None
    out = []
    for rank, lang in enumerate(langs):
        for at, (_, leaf, other, i) in enumerate(sorted(by[lang])):
            cur, beside = other, []
            for levels, p in ((trees[lang], at), (top, rank)):
                for level in levels[:-1]:
                    x = level[p ^ 1] if p ^ 1 < len(level) else None
                    beside += [x] if x else []
                    cur = H(x, cur) if p & 1 else H(cur, x or "")
                    p >>= 1
            root = top[-1][0]
            out.append((i, leaf, trees[lang][-1][0], root, H(*beside), cur, cur == root))
    return out


def rows_of(n, langs, seed=1):
    pick = random.Random(seed)
    return [(i * 3, f"text {i} é", pick.choice(langs), pick.choice(["a", None]), pick.choice([5, None])) for i in range(n)]


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (1, [None]), (7, ["en"]), (90, ["en", "", None, "é", "z"]), (1030, ["en", "en", "en", "de"])])
def test_manifest_against_a_plain_version(spark, n, langs):
    rows = rows_of(n, langs)
    found = merkle.tampered_manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert multiset(found) == multiset(plain_manifest(rows))
    assert all(not r.verified for r in found if zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and rows[r.doc_id // 3][4] is not None)


def test_blocks_of_every_size_give_the_same_tree(spark):
    rows = rows_of(77, ["en", "en", "de", None]) + rows_of(3, ["fr"], 2) + [(None, None, None, None, None)] * 3 + rows_of(2, ["en"], 3)
    docs = spark.createDataFrame(rows, SCHEMA)
    expected = multiset((r[0], r[1], r[2], r[3]) for r in plain_manifest(rows))
    for bits in (1, 2, 3):
        found = merkle.prove(docs, bits=bits).collect()
        assert multiset((r.doc_id, r.leaf, r.subroot, r.root) for r in found) == expected, bits
        assert all(r.top == r.root and r.version is None for r in found)


def test_versions_copy_the_way_up_and_nothing_else(spark):
    from pyspark.sql import functions as F

    rows = rows_of(40, ["en"])
    found = merkle.prove(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") == 30, {"text": F.lit("other")}, bits=2).collect()
    hit = next(r for r in found if r.doc_id == 30)
    assert [r.doc_id for r in found if r.version] == [30] and len(hit.version) == 7 and hit.version[-1] == hit.top != hit.root
    i, _, lang, source, n = rows[10]
    rows[10] = (i, "other", lang, source, n)
    again = merkle.prove(spark.createDataFrame(rows, SCHEMA), bits=3).first()
    assert again.root == hit.top


# --- filters


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def plain_audit(rows, labels):
    good = {i for i, q, t in labels if q == 1 and i is not None}
    toxic = {i for i, q, t in labels if t == 1 and i is not None}
    least, out = {}, []
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = []
    for i, text, lang, *_ in rows:
        t = text or ""
        w = words(t)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t)]
        fails += [bool(re.search(r"[#$%&*|]", t)), i is not None and least[t] < i]
        docs.append((lang or "", {f for f, x in zip("ABCDE", fails, strict=True) if x}, i in good, i in toxic))
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        result, total = [], collections.Counter()
        for order in itertools.permutations("ABCDE"):
            rest = own
            for step, f in enumerate(order, 1):
                gone = [d for d in rest if f in d[1]]
                redundant = sum(f in d[1] for d in own) - len(gone)
                rest = [d for d in rest if f not in d[1]]
                total[f] += len(gone)
                unique = sum(d[1] == {f} for d in own)
                result.append((part, "".join(order), step, len(rest), len(gone), redundant, unique, sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out += [(*r, total[r[1][r[2] - 1]]) for r in result]
    return out


def test_audit_against_a_plain_version(spark):
    pick = random.Random(9)
    rows = []
    for i in range(250):
        text = " ".join(pick.choice(["Word", "lower", f"w{pick.randint(0, 400)}", "#", "é"][: pick.choice([2, 3, 5])]) for _ in range(pick.choice([0, 3, 150, 260])))
        rows.append((i, pick.choice([text, text, None, "copy of one text", "copy of one text\x0b"]), pick.choice(["en", "de", None, ""]), "s", 1))
    rows += [rows[3]] * 2 + [(None, "copy of one text", "en", "s", 1), (None, "only one", "en", "s", 1), (None, "only one", "fr", "s", 1), (-5, rows[5][1], "de", "s", 1)]
    labels = [(pick.randint(0, 250), pick.choice([0, 1, None]), pick.choice([0, 1])) for _ in range(300)] + [(None, 1, 1)]
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit.filter_audit(docs, marks).collect()
    assert multiset(found) == multiset(plain_audit(rows, labels))
    none = audit.filter_audit(docs, marks.limit(0)).collect()
    assert multiset(none) == multiset(plain_audit(rows, []))


def test_the_sketch_clears_most_texts_and_no_repeat(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "concat('text ', id % 19000) AS text")
    keys = rows.select("doc_id", *audit._key(rows.text))
    segments = audit.segments_for(20_000)
    marked = audit.with_possible(keys, audit.sketch(keys, segments), segments).filter("possible")
    found = {r.doc_id for r in marked.collect()}
    repeats = {i for i in range(20_000) if i % 19000 < 1000}
    assert repeats <= found and len(found - repeats) < 400


# --- edges

CLASH = "doc_id long, text string, lang string, source string, n_chars long, hi long, pos long, node string, part string, mask int, segment long, id string, key_a string, `odd name.x` string"
EXTRA = (1, 2, "n", "p", 3, 4, "i", "k", "o")


def test_clashing_names_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "", 0), (3, "A\nb", "en", "s", 1), (3, "A\nb", "en", "s", 1), (None, "x" * 200_000 + " y" * 50_000, "", "s", 1)]
    docs = spark.createDataFrame([r + EXTRA for r in rows], CLASH)
    none = docs.limit(0)
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    assert multiset(linededup.line_dedup(docs).collect()) == multiset(plain_dedup([r[:2] for r in rows]))
    assert multiset(merkle.tampered_manifest(docs).collect()) == multiset(plain_manifest(rows))
    assert multiset(audit.filter_audit(docs, labels).collect()) == multiset(plain_audit(rows, [(3, 1, 0)]))
    for f in (linededup.line_dedup, merkle.tampered_manifest, lambda d: audit.filter_audit(d, labels)):
        assert f(none).collect() == [] and f(none).columns == f(docs).columns
