import hashlib
import zlib

from tessera.llm import merkle
from tessera.llm.common import read_table

COLUMNS = "doc_id long, source string, lang string, n_chars int, text string, leaf string, pos int"
UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes, index):
    """Siblings and places on the way of one node; the top."""
    steps = []
    while len(nodes) > 1:
        low = index - index % 16
        steps.append((nodes[low:low + 16], index % 16))
        nodes, index = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)], index // 16
    return steps, nodes[0]


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded) by the definition, on one machine."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf(r)))) for s in names}
    subroots = [climb([leaf(r) for r in trees[s]], 0)[1] for s in names]
    out = []
    for i, s in enumerate(names):
        leaves = [leaf(r) for r in trees[s]]
        over, root = climb(subroots, i)
        for j, r in enumerate(trees[s]):
            steps = climb(leaves, j)[0] + over
            proof = h(*[x for run, at in steps for k, x in enumerate(run) if k != at])
            changed = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                changed[4] = r[4].translate(str.maketrans(UP, LOW))
            node = leaf(changed)
            for run, at in steps:
                node = h(*run[:at], node, *run[at + 1:])
            out.append((r[0], leaves[j], subroots[i], root, proof, node, node == root))
    return out


def collect(df):
    return [(r[0], r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], COLUMNS)


def test_edge_rows_match_the_definition(spark):
    rows = [(5, "b", "en", 3, "ABC"), (None, "b", None, None, None), (5, "b", "en", 3, "ABC"), (5, "b", "en", 3, "ABC"),
            (1, None, "de", 0, ""), (2, None, None, 4, "Äb C"), (10, "ä", "en", 1, "x"), (3, "", "en", 1, "Q"),
            (7, "z", "fr", 600_000, "Very long " * 60_000), (-4, "b", "en", 1, "é" * 3)]
    got = collect(merkle.report(frame(spark, rows)))
    assert order(got) == order(plain(rows))


def test_uneven_groups_over_several_superblocks(spark):
    # runs that end with one node, a group over the square of a superblock's side, lone leaves
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(256 * 17 + 1)]
    rows += [(10_000 + i, f"s{i % 37:02d}", None, i, f"Other {i}") for i in range(500)]
    rows += [(20_000 + i, f"lone{i}", None, i, None) for i in range(40)] + [(30_000 + i, "run", "x", i, "T") for i in range(17)]
    got = collect(merkle.report(frame(spark, rows)))
    assert order(got) == order(plain(rows))
    bad = {r[0] for r in got if not r[6]}
    assert bad == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None and r[4] != r[4].lower()}


def test_repeated_row_holds_a_third(spark):
    rows = [(1, "s", "en", 2, "Ab")] * 700 + [(i, "s", "en", 2, "Ab") for i in range(1400)]
    assert order(collect(merkle.report(frame(spark, rows)))) == order(plain(rows))


def test_one_row_and_no_rows(spark):
    rows = [(15, "s", "en", 2, "Ab")]
    assert collect(merkle.report(frame(spark, rows))) == plain(rows)
    assert plain(rows)[0][4] == h()  # no siblings at all
    assert merkle.report(frame(spark, [])).count() == 0


def test_full_proofs_fold_to_the_root(spark):
    rows = [(i, f"s{i % 3}", "en", 1, f"T{i}") for i in range(300)]
    out = merkle.manifest(frame(spark, rows), with_proof=True).collect()
    for r in out:
        path = r.proof.split("/")
        assert merkle.fold(r.leaf, path) == r.root and r.verified
        assert merkle.digest([merkle.siblings(path)]) == r.proof_sha256


def test_whole_table(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    assert order(collect(merkle.report(docs))) == order(plain(rows))
