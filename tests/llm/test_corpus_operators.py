"""Operators over the whole corpus, against brute force."""

import hashlib
import itertools
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from playmart.llm import common, decontaminate, line_dedup, packing, pieces, simhash, substring_dedup
from playmart.llm.components import components
from playmart.llm.queries import QUERIES, WORD_VOCABULARY
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD, prose

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def joined(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


# SimHash ---------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def plain_components(prints):
    close = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    return joined(close, prints)


def test_triples_are_in_every_four_positions():
    chosen = [set(t) for t in simhash.triples()]
    assert len(chosen) == 20
    assert all(any(t <= set(four) for t in chosen) for four in itertools.combinations(range(8), 4))


def test_simhash_query(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op2_simhash"](spark, SF).collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    roots = plain_components(prints)
    assert {i: (f"{prints[i]:016x}", roots[i]) for i in texts} == {
        i: (r.fingerprint, r.component_id) for i, r in found.items()
    }


@pytest.mark.parametrize("block", [simhash.BLOCK, 7])
def test_links_connect_what_is_close(spark, rng, block):
    """Dense groups, chains and pairs at exactly four and five bits, also with lists cut into many blocks."""
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        prints.add(centre)
        for _ in range(12):
            for _ in range(rng.randrange(6)):
                centre ^= 1 << rng.randrange(64)
            prints.add(centre)
    centre = rng.getrandbits(64)
    prints |= {centre ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(0, 64, 5), 2)}
    prints |= {rng.getrandbits(64) for _ in range(200)}
    expected = plain_components({p: p for p in prints})
    nodes = spark.createDataFrame([(p - (p >> 63 << 64),) for p in prints], "fp bigint")
    found = simhash.links(nodes, 4, block).collect()
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in found]
    assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
    assert joined(pairs, prints) == expected
    short = simhash.links(nodes, 4, block, contract=True).collect()
    assert joined([(r.a % (1 << 64), r.b % (1 << 64)) for r in short], prints) == expected


def test_simhash_odd_input(spark, frame, rng):
    text = prose(rng, 300)
    rows = [*enumerate(ODD), (100, text), (101, text), (101, text), (102, text + " x"), (None, text), (None, None)]
    found = simhash.near_duplicates(frame(rows, 3)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(dict(enumerate(prints)))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[roots[k]] = min(i, least.get(roots[k], i))
    expected = [(i, f"{prints[k]:016x}", least.get(roots[k])) for k, (i, _) in enumerate(rows)]
    assert sorted(map(repr, expected)) == sorted(repr((r.doc_id, r.fingerprint, r.component_id)) for r in found)
    stay = simhash.first_of_groups(frame(rows, 3))
    ids = [r.doc_id for r in stay.collect()]
    assert 100 in ids and 101 not in ids and ids.count(None) == 0
    assert simhash.near_duplicates(frame([])).count() == 0 and simhash.first_of_groups(frame([])).count() == 0


def test_one_row_of_a_group_stays(spark, frame, rng):
    """Rows that repeat the smallest id, copies without an id, and an id that is later in one group only."""
    a, b, c, d = (prose(rng, 300) for _ in range(4))
    rows = [(1, a), (1, a), (2, a), (None, b), (None, b), (None, b), (7, c), (None, c), (None, c), (2, d), (9, d)]
    stay = simhash.first_of_groups(frame(rows, 3))
    assert stay.columns == frame(rows).columns
    assert sorted(repr((r.doc_id, r.text)) for r in stay.collect()) == sorted(
        map(repr, [(1, a), (None, b), (7, c), (2, d)])
    )
    many = frame([(None, a)] * 200 + [(k, b) for k in range(50)] * 2, 7)
    assert sorted(repr(r.doc_id) for r in simhash.first_of_groups(many).collect()) == ["0", "None"]


def test_components(spark, rng):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(200, 200), (7, 3)]
    chain += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    expected = joined(chain, {n for e in chain for n in e})
    assert found == {n: r for n, r in expected.items() if n in found}
    assert {n for n in expected if n not in found} <= {200} | {a for a, b in chain if a == b}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Decontamination -------------------------------------------------------------------------------------


def plain_tiles(doc, item, least):
    """Greedy string tiling by the book: longest match of unmarked words first."""
    used_p, used_q, tiles = set(), set(), []
    while True:
        best = None
        for q in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while (
                    p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n]
                    and p + n not in used_p and q + n not in used_q
                ):
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (p, q, n)
        if best is None:
            return tiles
        tiles.append(best)
        used_p |= set(range(best[0], best[0] + best[2]))
        used_q |= set(range(best[1], best[1] + best[2]))


def test_tiling(spark, rng):
    words = [w for w in "abcdefg"]
    items = [[rng.choice(words) + rng.choice("xy") for _ in range(rng.randrange(3, 40))] for _ in range(12)]
    docs = []
    for n in range(60):
        text = []
        for _ in range(rng.randrange(4)):
            item = rng.choice(items)
            cut = rng.randrange(len(item))
            text += item[cut:] + item[:cut] if n % 2 else item[cut : cut + 9]
        docs.append(text)
    left = [(n, " ".join(d)) for n, d in enumerate(docs)] + [(None, None), (70, ""), (0, " ".join(docs[0]))]
    right = [(n, " ".join(i).upper() + "!") for n, i in enumerate(items)] + [(90, None), (91, "a b"), (0, items and " ".join(items[0]))]
    docs_df = spark.createDataFrame(left, "doc_id bigint, text string")
    items_df = spark.createDataFrame(right, "item_id bigint, text string")
    found = decontaminate.contaminated_pairs(docs_df, items_df, 0.0).collect()
    got = {(r.doc_id, r.item_id): sorted((t.doc_word, t.item_word, t.words) for t in r.tiles) for r in found}
    expected = {}
    for n, d in enumerate(docs):
        for m, i in enumerate(items):
            if tiles := plain_tiles(d, i, decontaminate.SEED_WORDS):
                expected[n, m] = sorted(tiles)
    assert got == expected
    clean = decontaminate.decontaminate(docs_df, items_df)
    bad = {k[0] for k, ts in expected.items() if sum(t[2] for t in ts) >= decontaminate.COVERAGE * len(items[k[1]])}
    assert bad and {r.doc_id for r in clean.collect()} == {i for i, _ in left} - bad
    assert decontaminate.contaminated_pairs(docs_df, items_df.limit(0)).count() == 0
    assert decontaminate.decontaminate(docs_df.limit(0), items_df).count() == 0


def test_reordered_passage_is_caught(spark, rng):
    item = prose(rng, 40).replace("\n", " ").split()
    other = item[20:] + ["something", "else"] + item[:20]
    docs = spark.createDataFrame([(1, " ".join(other)), (2, prose(rng, 60))], "doc_id bigint, text string")
    items = spark.createDataFrame([(5, " ".join(item))], "item_id bigint, text string")
    assert [(r.doc_id, r.n_tiles) for r in decontaminate.contaminated_pairs(docs, items).collect()] == [(1, 2)]


def test_decontamination_query(spark, texts):
    """Every whole item in a document is found, and nothing where no five words are shared."""
    found = {(r.doc_id, r.item_id) for r in QUERIES["op5_decontamination"](spark, SF).collect()}

    def words(text):
        return re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())

    for item in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        needle = " " + " ".join(words(item.text)) + " "
        grams = {tuple(words(item.text)[k : k + 5]) for k in range(len(words(item.text)) - 4)}
        for i, text in texts.items():
            have = words(text)
            if needle in f" {' '.join(have)} ":
                assert (i, item.item_id) in found
            elif not grams & {tuple(have[k : k + 5]) for k in range(len(have) - 4)}:
                assert (i, item.item_id) not in found


# Line dedup ------------------------------------------------------------------------------------------


def plain_line_dedup(rows, least=line_dedup.MIN_WORDS, documents=line_dedup.LINE_DOCUMENTS):
    """rows: (order, text), all different. The text that stays: no line of a later copy of any repeated run of enough
    words does, nor a later copy of a line that stands in enough documents."""
    first, gone, found = {}, {}, {}
    rows = sorted(rows, key=lambda r: r[0])
    for key, text in rows:
        for line in set((text or "").split("\n")):
            found[line] = found.get(line, 0) + 1
    for key, text in rows:
        lines = (text or "").split("\n")
        held = [k for k, x in enumerate(lines) if x.encode().split()]
        for a in range(len(held)):
            words = 0
            for b in range(a, len(held)):
                words += len(lines[held[b]].encode().split())
                run = tuple(lines[k] for k in held[a : b + 1])
                if words >= least or (a == b and found[run[0]] >= documents):
                    if first.setdefault(run, (key, a)) != (key, a):
                        gone.setdefault(key, set()).update(range(held[a], held[b] + 1))
                    elif b - a > 60:
                        break  # longer runs from here are new as well
    return {
        key: text if key not in gone else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone[key])
        for key, text in rows
    }


def test_line_dedup_against_brute_force(spark, frame, rng):
    lines = [" ".join(rng.choice("abcde") for _ in range(rng.choice([1, 2, 3, 6, 12]))) for _ in range(25)] + ["", " ", "\t"]
    rare = [" ".join(rng.choices("fghij", k=3)) for _ in range(200)]
    rows = [(i, "\n".join(rng.choice(rng.choice([lines, rare])) for _ in range(rng.randrange(30)))) for i in range(120)]
    rows += [(200 + i, t) for i, t in enumerate(ODD)] + [(300, rows[5][1]), (301, f"{rows[6][1]}\nend")]
    expected = plain_line_dedup(rows, documents=40)
    assert expected != plain_line_dedup(rows, documents=1000) != {i: t for i, t in rows}
    out = line_dedup.delete_repeated_runs(frame(rows, 3), line_documents=40).collect()
    assert {r.doc_id: r.text for r in out} == expected
    stay = line_dedup.line_dedup(frame(rows, 3))
    assert stay.columns == frame(rows).columns
    kept = {r.doc_id for r in stay.select("doc_id").collect()}
    assert {i for i, t in rows if not (t or "").encode().split()} <= kept
    # Repeated rows are one document; a null id comes first; equal ids are different documents.
    text = " ".join("abcdefghijkl")
    again = frame([(1, text), (1, text), (None, text), (1, text + "\nz")])
    got = sorted(repr((r.doc_id, r.text)) for r in line_dedup.delete_repeated_runs(again).collect())
    assert got == sorted(map(repr, [(1, ""), (1, ""), (None, text), (1, "z")]))
    assert line_dedup.line_dedup(frame([])).count() == 0


def test_line_dedup_of_whole_runs(spark, frame):
    """No tail of a copy stays, and of a frequent short line the first place only."""
    long, mid, short = " ".join("abcdefghijkl"), "m n o", "p q"
    tail = [(1, f"{long}\n{mid}\n{short}"), (2, f"{long}\n{mid}\n{short}"), (3, f"x\n{long}\n{mid}\n{short}\ny")]
    menu = [(10 + k, f"u{k}\nmenu\nv{k}\nmenu") for k in range(line_dedup.LINE_DOCUMENTS)]
    few = [(50 + k, f"r{k}\nseldom\nseldom\nseldom\ns{k}") for k in range(line_dedup.LINE_DOCUMENTS - 1)]
    out = {r.doc_id: r.text for r in line_dedup.delete_repeated_runs(frame(tail + menu + few)).collect()}
    assert [out[i] for i in (1, 2, 3)] == [tail[0][1], "", "x\ny"]
    assert out[10] == "u0\nmenu\nv0" and out[11] == "u1\nv1"
    assert all(out[i] == t for i, t in few)


def test_line_dedup_query(spark, texts):
    kept = plain_line_dedup(list(texts.items()))
    for r in QUERIES["op6_line_dedup"](spark, SF).collect():
        assert r.kept_sha256 == hashlib.sha256(kept[r.doc_id].encode()).hexdigest()
        assert r.n_lines == sum(bool(x.encode().split()) for x in texts[r.doc_id].split("\n"))


# Repeated strings ------------------------------------------------------------------------------------


def plain_removed(rows):
    """rows: (order, bytes). Per row what is removed, as a mask."""
    seen, out = set(), []
    for _, data in sorted(rows, key=lambda r: r[0]):
        mask = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            part = data[k : k + 100]
            mask[k : k + 100] |= part in seen
            seen.add(part)
        out.append(mask)
    return out


def test_repeated_strings_of_extreme_ids(spark, frame, rng):
    text = prose(rng, 60)
    rows = [(-(1 << 63), text), (-(1 << 62) - 5, text), ((1 << 63) - 1, text), (None, text)]
    found = substring_dedup.remove_repeated(frame(rows)).collect()
    assert sorted(map(repr, (r.doc_id for r in found))) == sorted(repr(i) for i, _ in rows)
    assert sum(r.n_removed == 0 for r in found) == 1


def check_removed(found, rows):
    masks = dict(zip([r[0] for r in sorted(rows)], plain_removed(rows)))
    data = dict(rows)
    for r in found:
        mask, text = masks[r.doc_id], np.frombuffer(data[r.doc_id], np.uint8)
        runs = int((np.diff(np.concatenate(([0], mask.view(np.int8)))) == 1).sum())
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(text), int(mask.sum()), runs), r.doc_id
        assert bytes(r.kept) == text[~mask].tobytes()
    assert len(found) == len(rows)


def test_repeated_strings_against_brute_force(spark, frame, rng):
    base = ["".join(rng.choice("ab cé") for _ in range(rng.randrange(50, 600))) for _ in range(12)]
    rows = []
    for i in range(150):
        text = ""
        for _ in range(rng.randrange(4)):
            part = rng.choice(base)
            cut = rng.randrange(len(part))
            text += part[cut : cut + rng.randrange(40, 400)] + "".join(rng.choice("xyz") for _ in range(rng.randrange(3)))
        rows.append((i, text))
    rows += [(200 + i, t) for i, t in enumerate(ODD)]
    rows += [(300, "a" * 700), (301, "ab" * 400), (302, "a" * 150 + "b" * 150 + "a" * 150), (303, "\0" * 250), (304, "q" + "\0" * 99), (305, "\0" * 130)]
    rows += [(306, "z" * 99), (307, "z" * 99), (308, "y" * 100), (309, "y" * 100)]
    found = substring_dedup.remove_repeated(frame(rows, 3)).collect()
    check_removed(found, [(i, (t or "").encode()) for i, t in rows])


def test_repeated_strings_query(spark, texts):
    found = substring_dedup.remove_repeated(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    check_removed(found, [(i, t.encode()) for i, t in texts.items()])
    rows = QUERIES["op7_substring_dedup"](spark, SF).collect()
    digests = {r.doc_id: hashlib.sha256(bytes(r.kept)).hexdigest() for r in found}
    assert {r.doc_id: r.kept_sha256 for r in rows} == digests


def test_repeated_strings_of_repeated_rows(spark, frame, rng):
    text = prose(rng, 100)
    rows = frame([(5, text), (5, text), (None, text), (None, None), (6, text[:120])])
    found = substring_dedup.remove_repeated(rows).collect()
    whole = [r for r in found if r.n_bytes and not r.n_removed]
    assert len(found) == 5 and [r.doc_id for r in whole] == [None]
    assert substring_dedup.remove_repeated(frame([])).count() == 0


# Packing ---------------------------------------------------------------------------------------------


def check_packed(found, capacity):
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
    return len(by_sequence)


def fewest(lengths, capacity):
    """Fewest sequences, by trying every place."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= lengths[k]}.values():
            place(k + 1, [*rooms[:j], rooms[j] - lengths[k], *rooms[j + 1 :]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best


def test_reduction_never_costs_a_sequence(rng):
    """Fixing the dominating sets leaves an instance that still reaches the optimum."""
    for _ in range(300):
        capacity = rng.choice([10, 20, 30])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(1, 10))]
        patterns = packing.solve({k: lengths.count(k) for k in set(lengths)}, capacity)
        got = [k for p in patterns for _ in range(p.times) for k, n in p.runs for _ in range(n)]
        assert sorted(got) == sorted(lengths)
        assert all(sum(k * n for k, n in p.runs) <= capacity for p in patterns)
        best = fewest(lengths, capacity)
        leading = list(itertools.takewhile(lambda p: p.fixed, patterns))
        taken = [k for p in leading for _ in range(p.times) for k, n in p.runs for _ in range(n)]
        rest = list(lengths)
        for k in taken:
            rest.remove(k)
        assert sum(p.times for p in leading) + (fewest(rest, capacity) if rest else 0) == best
        assert sum(p.times for p in patterns) <= max(best + 1, best * 11 / 9 + 1)


def test_packing_query(spark, texts):
    found = QUERIES["op10_best_fit_packing"](spark, SF).collect()
    library = pieces.vocabulary(WORD_VOCABULARY).library
    expected = []
    for i, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        for n, k in enumerate(range(0, len(ids), 4096)):
            part = ids[k : k + 4096]
            expected.append((i, n, k, len(part), zlib.crc32(part.tobytes())))
    assert sorted(expected) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    total = sum(e[3] for e in expected)
    assert check_packed(found, 4096) <= -(-total // 4096) * 1.02 + 1


def test_packing_odd_input(spark, frame, rng):
    rows = [*enumerate(ODD), (None, "a b c"), (None, "a b c"), (3, "a"), (3, "a"), (50, prose(rng, 3000))]
    found = packing.pack_documents(frame(rows, 3), WORD_VOCABULARY, 64).collect()
    check_packed(found, 64)
    assert len({(r.sequence_id, r.offset) for r in found}) == len(found)
    starts = [r.doc_id for r in found if r.piece == 0]
    assert sorted(map(repr, starts)) == sorted(repr(i) for i, _ in rows)
    assert packing.pack_documents(frame([]), WORD_VOCABULARY).count() == 0


def plain_windows(around, left, right):
    out = np.zeros((len(around), substring_dedup.WINDOWS), bool)
    for r in range(substring_dedup.WINDOWS):
        seen, first = set(), substring_dedup.SIDE - r
        for i, row in enumerate(around):
            if left[i] >= r and right[i] >= first:
                window = row[first : first + substring_dedup.MIN_BYTES].tobytes()
                out[i, r] = window in seen
                seen.add(window)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_interval_expansion_equals_comparing_all_windows(seed):
    rng = np.random.default_rng(seed)
    side, gram = substring_dedup.SIDE, substring_dedup.GRAM
    n, width = int(rng.integers(1, 80)), 2 * side + gram
    around = rng.integers(0, 2, (3, width)).astype(np.uint8)[rng.integers(0, 3, n)]
    for row in around:
        row[rng.integers(0, width, rng.integers(0, 3))] ^= 1
    around[:, side : side + gram] = rng.integers(0, 2, (2, gram))[rng.integers(0, 2, n)]
    left, right = rng.choice([0, 10, 40, side, side], n), rng.choice([0, 30, side - 1, side, side], n)
    at = np.arange(width)
    around[(at < side - left[:, None]) | (at >= side + gram + right[:, None])] = 0
    assert (substring_dedup.repeated_windows(around, left, right) == plain_windows(around, left, right)).all()


@pytest.mark.parametrize("size", [1, 2, 3, 1000])
def test_anchors_are_settled_alike_in_batches_of_any_size(size):
    rng = np.random.default_rng(size)
    rows = [(int(rng.integers(-3, 4)), int(rng.integers(-2, 3)), d, 0, int(rng.integers(0, 5))) for d in range(200)]
    rows.sort()
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[k : k + size])], substring_dedup._KEYED)
        for k in range(0, len(rows), size)
    ]
    found = [tuple(r.values()) for b in substring_dedup._settle(iter(batches)) for r in b.to_pylist()]
    kinds, expected, led = {}, [], set()
    for gram, around, *_ in rows:
        if around != substring_dedup.SETTLED:
            kinds.setdefault(gram, set()).add(around)
    for gram, around, doc, sub, pos in rows:
        whole = around == substring_dedup.SETTLED or (gram, around) in led
        led.add((gram, around))
        if whole or len(kinds[gram]) > 1:
            expected.append((doc, sub, pos, gram, whole))
    assert sorted(found) == sorted(expected)


def test_the_tally_rejects_pairs_before_their_bits_are_compared():
    """In a posting list of three equal bytes most pairs share no fourth; the rest are verified."""
    rng = np.random.default_rng(7)
    f = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    f = (f & ~np.uint64(0xFFFFFF)) | np.uint64(0x123456)
    f[2000:2500] = f[:500] ^ np.uint64(0b1011 << 40)
    f[2500:] = f[:500] ^ np.uint64(0xFF << 40)
    a, b = (f[k] for k in np.triu_indices(len(f), 1))
    kept, found = simhash.tally(a, b) >= simhash.MIN_SHARED, simhash.linked(a, b)
    assert kept.mean() < 0.05 and 500 <= found.sum() < kept.sum()
    assert (found == (np.bitwise_count(a ^ b) <= simhash.MAX_BITS)).all()
    assert (simhash.linked(f, f[5]) == (np.bitwise_count(f ^ f[5]) <= simhash.MAX_BITS)).all()


def large_batch(rng, docs):
    """Anchors of a batch of texts that share passages, and what _settle makes of them, listed by document."""
    shared = [prose(rng, 60) for _ in range(6)]
    texts = [" ".join([prose(rng, 120), rng.choice(shared), prose(rng, 40)]).encode() for _ in range(docs)] + [b"", b"short"]
    ids = [k // 2 for k in range(len(texts))]
    columns = [pa.array(ids), pa.array([2 * (k % 2) + 1 for k in range(len(texts))], pa.int32()), pa.array(texts)]
    base = pa.RecordBatch.from_arrays(columns, ["doc", "sub", "text"])
    found = pa.Table.from_batches(substring_dedup._find_anchors(iter([base])))
    rows = found.sort_by([(c, "ascending") for c in substring_dedup._KEYED]).combine_chunks()
    wanted = {(i, s): [] for i, s in zip(ids, columns[1].to_pylist())}
    for batch in substring_dedup._settle(iter(rows.to_batches())):
        for r in batch.to_pylist():
            wanted[r["doc"], r["sub"]].append({k: r[k] for k in ("pos", "gram", "whole")})
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("gram", pa.int64()), ("whole", pa.bool_())]))
    return base, base.append_column("wanted", pa.array(list(wanted.values()), kind))


def rows_of(batches):
    return sorted((tuple(r.values()) for b in batches for r in b.to_pylist()), key=repr)


def test_substring_steps_send_small_batches(rng, monkeypatch):
    """A batch of any size is worked on and sent on in pieces, with the same rows."""
    base, wanted = large_batch(rng, 1300)
    assert not wanted.column(3).null_count and sum(map(len, wanted.column(3).to_pylist())) > 10000
    anchors, parts = rows_of(substring_dedup._find_anchors(iter([base]))), rows_of(substring_dedup._fetch(iter([wanted])))
    expected = []
    for doc, sub, text, listed in zip(*(c.to_pylist() for c in wanted.columns)):
        covered = np.zeros(len(text) + 1, bool)
        for w in listed:
            low, high = max(0, w["pos"] - substring_dedup.SIDE), min(len(text), w["pos"] + substring_dedup.MIN_BYTES)
            if w["whole"]:
                covered[low:high] = True
            else:
                expected.append((w["gram"], doc, sub, w["pos"], low, high, text[low:high]))
        key = int(common.mix(np.array([doc]).astype(np.uint64)).view(np.int64)[0])
        expected += [(key, doc, sub, -1, int(a), int(b), None) for a, b in zip(*common.spans(covered))]
    assert parts == sorted(expected, key=repr)
    kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
    ranges = [None if k % 3 == 0 else [{"low": b, "high": b + 9} for b in (40, 45, 3)][: k % 5] for k in range(1302)]
    ranges[1300:] = [None, []]
    cut = base.append_column("covered", pa.array(ranges, kind))
    whole = rows_of(substring_dedup._cut(iter([cut])))
    plain = []
    for doc, sub, text, listed in zip(*(c.to_pylist() for c in cut.columns)):
        gone = {p for r in listed or [] for p in range(r["low"], r["high"])}
        spans = sum(p - 1 not in gone for p in gone)
        plain.append((doc, len(text), len(gone), spans, bytes(c for p, c in enumerate(text) if p not in gone)))
    assert whole == sorted(plain, key=repr)
    monkeypatch.setattr(substring_dedup, "DOCS", 7)
    monkeypatch.setattr(substring_dedup, "SENT", 40)
    for step, given, same, most in (
        (substring_dedup._find_anchors, base, anchors, 40), (substring_dedup._fetch, wanted, parts, 40),
        (substring_dedup._cut, cut, whole, 7),
    ):
        batches = list(step(iter([given])))
        assert rows_of(batches) == same
        assert max(b.num_rows for b in batches) <= most < len(same)
        assert rows_of(step(iter([given.slice(5, 900)]))) == rows_of(step(iter([pa.RecordBatch.from_pylist(given.slice(5, 900).to_pylist(), given.schema)])))


def test_substring_fetch_holds_no_object_per_anchor(rng):
    base, wanted = large_batch(rng, 1300)
    tracemalloc.start()
    try:
        for _ in substring_dedup._fetch(iter([wanted])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 6 << 20, peak
