"""Vector codes, exact duplicates and token alignment against plain versions."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import alignment, exactdup, shared, vectorcodes
from sievework.llm.queries import tokenizer_path
from tests.llm.conftest import prose

A_PATH, B_PATH = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


# --- vector codes ----------------------------------------------------------------------------------------------------


def brute_codes(rows, entries=256):
    """Lloyd's rounds over Python integers; every distance is computed."""
    rows = [(i, label, [math.floor(x * 1024) if abs(x) < 2**52 else int(x) * 1024 for x in v]) for i, label, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not rows:
        return []
    q = -(-max(len(v) for *_, v in rows) // 4)
    rows = sorted(((i, label, v + [0] * (4 * q - len(v))) for i, label, v in rows), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    parts = [[r[2][p * q : (p + 1) * q] for r in rows] for p in range(4)]
    books = [part[:entries] for part in parts]

    def nearest():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book)) for x in part] for part, book in zip(parts, books)]

    for _ in range(4):
        found = nearest()
        for p in range(4):
            new = []
            for e, c in enumerate(books[p]):
                own = [x for x, (_, f) in zip(parts[p], found[p]) if f == e]
                new.append([sum(v) // len(own) for v in zip(*own)] if own else c)
            books[p] = new
    found = nearest()
    errors = [sum(found[p][k][0] for p in range(4)) for k in range(len(rows))]
    totals = Counter()
    for (_, label, _), e in zip(rows, errors):
        totals[label] += e
    fits = lambda v: v if v < 1 << 63 else None
    sha = hashlib.sha256(",".join(str(v) for book in books for c in book for v in c).encode()).hexdigest()
    return sorted([(i, "".join(f"{found[p][k][1]:02x}" for p in range(4)), fits(errors[k]), fits(totals[label]), sha) for k, (i, label, _) in enumerate(rows)], key=str)


def coded(df):
    return sorted((tuple(r) for r in vectorcodes.vector_codes(df).collect()), key=str)


def test_vector_codes_of_the_table(spark, sf_dir):
    df = shared.table(spark, sf_dir, "embeddings")
    assert coded(df) == brute_codes([tuple(r) for r in df.select("vec_id", "label", "embedding").collect()])


def test_vector_codes_of_ties_and_copies(spark):
    """Few distinct values: many entries are equal, and many points lie between two."""
    rng = random.Random(3)
    rows = [(i // 2 if i < 40 else i, i % 7 if i % 5 else None, [rng.choice([0.0, 0.25, -0.25, 0.001]) for _ in range(8)]) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(5)
    assert coded(df) == brute_codes(rows)


def test_vector_codes_of_odd_rows(spark):
    """Dropped rows, other lengths, repeated rows, no id, large ids, huge components, clashing names."""
    rows = [
        (1, 1, [1.0, 2.0, 3.0]), (1, 1, [1.0, 2.0, 3.0]), (2, None, [math.nan] * 3), (3, None, [1e30, -1e30, 0.5, 7.0, 1e20, 2.0]), (None, None, [0.0, -0.1]), (4, 2, None),
        (5, 2, []), (6, 2, [1.0, None]), (7, None, [math.inf]), ((1 << 62) + 1, 3, [2.0**60, 1.0, -3.3]), ((1 << 62) + 3, 3, [5000.0, 1.0, -3.3]), (9, 4, [-math.inf]),
    ]
    names = "codes bounds error part entry limb sums of total".split()
    df = spark.createDataFrame([(*r, *range(len(names))) for r in rows], "vec_id long, label int, embedding array<double>, " + ", ".join(f"`{n}` int" for n in names)).repartition(3)
    assert coded(df) == brute_codes(rows)
    assert coded(df.limit(0)) == [] and coded(df.where("vec_id = 2")) == []


def test_vector_codes_beyond_a_long(spark):
    """Points that leave huge entries: sums and errors that no long holds."""
    rng = random.Random(5)
    rows = [(i, i % 2, [rng.choice([1e12, -3e25, 0.5, 7e9]) * rng.random() for _ in range(4)]) for i in range(300)]
    assert coded(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")) == brute_codes(rows)


def test_bounds_skip_distances_and_lose_nothing():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 6)) * 40
    points = vectorcodes.whole_numbers(centres[rng.integers(0, 60, 3000)] + rng.normal(size=(3000, 6)))
    entries = points[:256]
    groups = vectorcodes.group_entries(entries)
    own = bounds = None
    work = []
    for _ in range(5):
        code, best, low, computed = vectorcodes.assign(points, entries, groups, own, bounds)
        full = vectorcodes.squared(points, entries)
        assert (code == full.argmin(1)).all() and (best == full.min(1)).all()
        for g, members in enumerate(groups):  # bounds hold for all entries but the point's own
            others = np.where(members[None] == code[:, None], np.inf, np.sqrt(full[:, members]))
            assert (low[:, g] <= others.min(1)).all()
        work.append(computed)
        new = np.array([np.floor(points[code == e].mean(0)) if (code == e).any() else entries[e] for e in range(256)])
        own, bounds, entries = code, low - vectorcodes.drifts(entries, new, groups), new
    assert work[-1] < work[0] / 2


# --- exact duplicates ------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=6), st.integers(1, 9))
def test_fingerprints_compose(texts, chunk):
    poly = exactdup.Polynomial()
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    whole = poly.spans(data, offsets)
    for i, t in enumerate(texts):
        plain = [sum(b * pow(base, j, poly.prime) for j, b in enumerate(t)) % poly.prime for base in poly.bases]
        cuts = [t[j : j + chunk] for j in range(0, len(t), chunk)]
        joined = np.frombuffer(t, np.uint8)
        at = np.cumsum([0, *map(len, cuts)])
        parts = poly.shifted(poly.spans(joined, at), at[:-1]) if cuts else np.zeros((4, 1), np.int64)
        assert whole[:, i].tolist() == plain == (parts.sum(1) % poly.prime).tolist()


def brute_copies(rows):
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", []).append(i)
    out = []
    for t, ids in by_text.items():
        best = max((i for i in ids if i is not None), default=None)
        once = ids.index(best)
        out += [(i, best, len(ids), k == once, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def copy_rows():
    long = prose(70, 4000)
    rows = [(i, long if i % 3 else long[:-1] + "!") for i in range(9)] + [(None, long), (None, None), (None, ""), (20, ""), (20, ""), ((1 << 62) + 1, "a"), ((1 << 62) + 3, "a"), (21, "A"), (22, "a ")]
    return rows + [(30 + i, prose(80 + i % 5, 30)) for i in range(20)] + [(60, "\0"), (61, "\0\0"), (62, "é" * 2000), (63, "é" * 2000)]


def copies(df, **options):
    return sorted((tuple(r) for r in exactdup.exact_duplicates(df, **options).collect()), key=str)


@pytest.mark.parametrize("chunk, prime", [(exactdup.CHUNK, exactdup.PRIME), (1000, exactdup.PRIME), (1000, 3)])
def test_exact_duplicates(spark, chunk, prime):
    """In one chunk, in many, and with fingerprints that hardly tell texts apart."""
    rows = copy_rows()
    names = "row x x2 of at data bytes size h0 best group_size sha256".split()
    df = spark.createDataFrame([(*r, *range(len(names))) for r in rows], "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names)).repartition(3)
    assert copies(df, chunk=chunk, poly=exactdup.Polynomial(prime)) == brute_copies(rows)


def test_unlike_texts_with_equal_fingerprints_are_told_apart(spark):
    rows = [(i, prose(i // 2, 5)[:20]) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert copies(df, chunk=7, poly=exactdup.Polynomial(2)) == brute_copies(rows)


def test_exact_duplicates_of_the_odd_table(odd, no_docs):
    assert copies(odd) == brute_copies([(r.doc_id, r.text) for r in odd.collect()])
    assert copies(no_docs) == []


# --- token alignment -------------------------------------------------------------------------------------------------


def brute_alignment(rows):
    """Cuts from sets of byte offsets; links by plain loops; counts by a Counter."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok, b_tok = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a_tok.encode_special_tokens = True
    chars = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in chars} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in chars)}
    docs, held = [], Counter()
    for i, t in rows:
        raw, found = (" " + (t or "")).encode(), None
        if t:
            enc = a_tok.encode(" " + t, add_special_tokens=False)
            a = [(n, bytes(byte[c] for c in a_tok.id_to_token(n))) for n in enc.ids]
            b = [(n, bytes([int(b_tok.id_to_piece(n)[3:5], 16)]) if b_tok.is_byte(n) else b_tok.id_to_piece(n).replace("▁", " ").encode()) for n in b_tok.encode(t)]
            if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b):
                ends = [{sum(len(x) for _, x in side[: k + 1]): k + 1 for k in range(len(side))} for side in (a, b)] if len(raw) < 3000 else [dict(zip(np.cumsum([len(x) for _, x in side]).tolist(), range(1, len(side) + 1))) for side in (a, b)]
                cuts = sorted(ends[0].keys() & ends[1].keys())
                found, fa, fb = [], 0, 0
                for c in cuts:
                    found.append(([n for n, _ in a[fa : ends[0][c]]], [n for n, _ in b[fb : ends[1][c]]]))
                    fa, fb = ends[0][c], ends[1][c]
        links = Counter((x, y) for ga, gb in found or [] for x in ga for y in gb)
        held.update(links.keys())
        docs.append((i, found, links))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for i, found, links in docs:
        if found is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        shown = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in found)
        top = sum(n for p, n in links.items() if held[p] == best[p[0]])
        out.append((i, sum(len(g) for g, _ in found), sum(len(g) for _, g in found), len(found), sum(links.values()), top, sum(n * held[p] for p, n in links.items()), hashlib.sha256(shown.encode()).hexdigest()))
    return sorted(out, key=str)


def linked(df):
    return sorted((tuple(r) for r in alignment.token_alignment(df, A_PATH, B_PATH).collect()), key=str)


def odd_strings():
    return ["  two  spaces\n\n\tand tabs ", " leading", "trailing ", "▁ folded", "<s> </s> <0x41> <|endoftext|> <unk>", "\x00\x01\r\n", "ﬁ ﬃ Å 한국어 日本語 🙂👩‍👩‍👧", "=" * 700, "x" * 3000, " ", "-" * 33 + "=" * 77 + "aaaa" * 40, "don't we'll I'M"]


def test_alignment(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(1000 + i, t) for i, t in enumerate(odd_strings() * 2)] + [(None, "no id"), ((1 << 62) + 1, "large id")]
    names = "block n_a places links pairs holders of place n top pair".split()
    df = spark.createDataFrame([(*r, *range(len(names))) for r in rows], "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names)).repartition(4)
    assert linked(df) == brute_alignment(rows)


def test_alignment_of_the_tables(spark, sf_dir):
    docs = shared.table(spark, sf_dir, "documents")
    assert linked(docs) == brute_alignment([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_alignment_of_nothing(no_docs):
    assert linked(no_docs) == []


def test_alignment_of_segments_and_large_groups(monkeypatch):
    """Short segments, few links at a time and groups by their distinct ids give what one piece gives."""
    texts = [None, "", *odd_strings(), prose(40, 900), prose(41, 400) + " ▁ " + prose(42, 300), "日本語" * 200 + " a b " * 50]
    voc = alignment.vocabularies(A_PATH, B_PATH)
    whole = alignment.align_block(texts, voc)
    for limits in ({"SEGMENT": 200}, {"LARGE": 3}, {"LINKS": 50}, {"SEGMENT": 50, "LARGE": 2, "LINKS": 5}):
        with monkeypatch.context() as m:
            for k, v in limits.items():
                m.setattr(alignment, k, v)
            cut = alignment.align_block(texts, voc)
        assert cut[0] == whole[0] and all((x == y).all() for x, y in zip(cut[1:], whole[1:]))


@given(st.lists(st.integers(0, 499), unique=True))
def test_rank_and_select(places):
    bits = alignment.Bits.of(np.array(sorted(places), np.int64), 500)
    assert bits.places().tolist() == sorted(places)
    assert bits.rank(np.arange(500)).tolist() == [sum(p <= at for p in places) for at in range(500)]
