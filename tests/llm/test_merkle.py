import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sozmill.llm import merkle

OWN = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(built, i):
    out = []
    for nodes in built[:-1]:
        out += [(-1 if i & 1 else 1, nodes[i ^ 1])] if i ^ 1 < len(nodes) else [(0, None)]
        i >>= 1
    return out


def fold(start, path):
    for side, digest in path:
        start = h(digest, start) if side < 0 else h(start, digest) if side else h(start)
    return start


def brute(rows):
    """Rows of ``doc_id, leaf, subroot, root, path`` by the contract."""
    groups = defaultdict(list)
    for r in rows:
        leaf = h(*(encoded(r[c]) for c in OWN))
        groups[r["lang"]].append(((r["doc_id"] is not None, r["doc_id"] or 0, leaf), r))
    langs = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    built = {k: levels([key[2] for key, _ in sorted(groups[k], key=lambda x: x[0])]) for k in langs}
    whole = levels([built[k][-1][0] for k in langs]) if langs else [[]]
    out = []
    for place, k in enumerate(langs):
        for i, (key, r) in enumerate(sorted(groups[k], key=lambda x: x[0])):
            path = siblings(built[k], i) + siblings(whole, place)
            out.append((r["doc_id"], key[2], built[k][-1][0], whole[-1][0], tuple(path)))
    return out, sum(map(len, whole)) + sum(len(level) for b in built.values() for level in b)


def check(docs):
    made = merkle.manifest(docs, "lang", "doc_id", merkle.leaf(*[F.col(c) for c in OWN]), doc_id=F.col("doc_id"))
    want, nodes = brute([r.asDict() for r in docs.select(*OWN).collect()])
    got = [(r.doc_id, r.leaf, r.subroot, r.root, tuple((s.side, s.digest) for s in r.path))
           for r in made.proofs().collect()]
    # Equal leaves stand at several places of a tree.
    assert Counter(got) == Counter(want)
    found = made.nodes().collect()
    assert len(found) == nodes
    by = defaultdict(list)
    for n in found:
        by[n.tree, n.level].append((n.low, n.high))
    for intervals in by.values():  # a level covers its leaves without gap or overlap
        ends = sorted(intervals)
        assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    return made


def test_documents(documents):
    check(documents)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_blocks_of_few_levels(documents, monkeypatch, bits):
    """Many steps, as a large tree has."""
    monkeypatch.setattr(merkle, "BITS", bits)
    check(documents)


def test_odd_rows(session, odd, documents, monkeypatch):
    monkeypatch.setattr(merkle, "BITS", 2)
    check(odd)
    check(odd.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "é").otherwise(F.col("lang"))))
    clash = odd
    for name in ("tree", "low", "high", "n", "digest", "block", "levels", "path", "root", "group", "__place"):
        clash = clash.withColumn(name, F.lit(1))
    check(clash)
    many = documents.withColumn("lang", F.concat("lang", F.col("doc_id").cast("string")))  # a tree for each row
    check(many)
    hot = documents.limit(1).crossJoin(session.range(300).select()).unionByName(documents)
    check(hot)
    empty = merkle.manifest(documents.limit(0), "lang", "doc_id", merkle.leaf(F.col("doc_id")), doc_id=F.col("doc_id"))
    assert empty.proofs().count() == 0 and empty.nodes().count() == 0


def test_tampering_is_found(session, documents):
    from sozmill.llm.queries import op13_merkle_manifest

    rows = op13_merkle_manifest(session, "/root/testdata/sf0.001").collect()
    want = {w[0]: w for w in brute([r.asDict() for r in documents.select(*OWN).collect()])[0]}
    given = {r.doc_id: r for r in documents.collect()}
    assert len(rows) == len(given) and any(not r.verified for r in rows)
    for r in rows:
        _, leaf, subroot, root, path = want[r.doc_id]
        doc = given[r.doc_id].asDict()
        if zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and doc["n_chars"] is not None:
            doc["n_chars"] += 1
        changed = h(*(encoded(doc[c]) for c in OWN))
        assert (r.leaf, r.subroot, r.root) == (leaf, subroot, root)
        assert r.proof_sha256 == h(*(d for _, d in path if d))
        assert r.folded_root == fold(changed, path) and r.verified == (changed == leaf)
