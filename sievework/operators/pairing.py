"""What `alignment` says of contexts and branches, for facts that name both of them, with little to send and to compare.

A line states some facts of a context and of a branch of a scope. Its words are made once, each distinct value of a batch once, and
lines go once to a task that holds whole scopes. There alike nodes are one profile, words are numbers and channels are bits: a bit is
a tag, and each role that a tag has in the scope a plane of bits. So a pair of profiles costs a few lookups and ands. Pairs are made,
scored and told in blocks of PAIRS; no pair is sent on to be summed up. A task holds the lines of its scopes, of a large scope all; but
the contexts of a large scope, and so its pairs, are dealt to several tasks."""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import alignment as al
from . import technology as tech

PAIRS = 1 << 17  # pairs of profiles that are looked at together
LARGE = 20_000  # contexts of a scope that one task pairs with its branches
_PLACES = {al.MODALITY: "0", al.CHEMISTRY: "1", al.ACQUISITION: "2"} | dict.fromkeys(al.ROLES, "3")
_KNOWN = tech.TECHNOLOGIES | {p + end: p for p in tech.PLEXES for end in ("", "plex")}
_LOWER = {c: c + 32 for c in range(65, 91)}
_WHITE = re.compile(r"[ \t\n\r\f\x0B]+")


# --- words -----------------------------------------------------------------------------------------------------------


def word(predicate: str, value: str) -> str | None:
    """The word that a fact adds to a node's sets, after the number of its set; what the keys of `technology` are."""
    v = _WHITE.sub(" ", value).strip(" ")
    short = re.sub("[^a-z0-9]", "", v.translate(_LOWER))
    if predicate == al.MODALITY:
        key = re.sub("^_|_$", "", re.sub("[^a-z0-9]+", "_", v.lower()))
        free = key == "labelfree" or key in tech.LABEL_FREE
        key = "label_free" if free else "reporter" if "reporter" in key else "unresolved" if key in tech.UNRESOLVED else key
    elif predicate == al.CHEMISTRY:
        key = _KNOWN.get(short) or v.lower()
    elif predicate == al.ACQUISITION:
        key = short if short in tech.ACQUISITIONS else v.lower()
    elif predicate in al.ROLES:
        key = _WHITE.sub("", v.upper().replace("TMT", ""))
        key = key and f"{predicate}:{key}"
    else:
        return None
    return _PLACES[predicate] + key if key else None


def told(lines: DataFrame, stated: Mapping[str, str]) -> DataFrame:
    """lines: scope, context, branch, status, method, conflict (of all facts of a line), sides (JSON of the branch's rows, as sides_of()
    gives it), and the values that stated names; stated: the predicate of each, or the column that has it -> scope, context,
    branch, words, dirty, sides."""

    def say(batches):
        known: dict = {}
        texts: list = []
        for batch in batches:
            if len(texts) > 100_000:
                known, texts = {}, []
            ids = np.full((batch.num_rows, len(stated)), -1, np.int64)
            for j, (value, predicate) in enumerate(stated.items()):
                v = batch.column(value).fill_null("").dictionary_encode()
                p = batch.column(predicate).fill_null("").dictionary_encode() if predicate in batch.schema.names else pa.repeat(predicate, batch.num_rows).dictionary_encode()
                ps, vs = p.dictionary.to_pylist(), v.dictionary.to_pylist()
                facts, at = np.unique(p.indices.to_numpy().astype(np.int64) * len(vs) + v.indices.to_numpy(), return_inverse=True)
                for fact in (facts := [(ps[c // len(vs)], vs[c % len(vs)]) for c in facts.tolist()]):
                    if fact not in known:
                        made = word(*fact)
                        known[fact] = -1 if made is None else len(texts)
                        texts += [] if made is None else [made]
                ids[:, j] = np.array([known[f] for f in facts], np.int64)[at]
            of = lambda c, x: pc.is_in(batch.column(c), value_set=pa.array(x)).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            some = lambda c: pc.not_equal(batch.column(c).fill_null(""), "").to_numpy(zero_copy_only=False)  # noqa: E731, B023
            usable = of("status", al.USABLE)
            dirty = (~usable & some("method")) | (of("status", al.IN_CONFLICT) & some("conflict"))
            there = (ids >= 0) & usable[:, None]
            words = pa.array(texts, pa.string()).take(pa.array(ids[there]))
            ends = pa.array(np.append(0, np.cumsum(there.sum(axis=1))), pa.int32())
            columns = [*(batch.column(c) for c in ("scope", "context", "branch")), pa.ListArray.from_arrays(ends, words), pa.array(dirty), batch.column("sides")]
            yield pa.RecordBatch.from_arrays(columns, ["scope", "context", "branch", "words", "dirty", "sides"])

    kind = {c: lines.schema[c].dataType.simpleString() for c in ("scope", "context", "branch")}
    named = dict.fromkeys([*stated, *(p for p in stated.values() if p in lines.columns)])
    rows = lines.where("scope is not null").select("scope", "context", "branch", "status", "method", "conflict", *named, "sides")
    return rows.mapInArrow(say, ", ".join(f"{c} {t}" for c, t in kind.items()) + ", words array<string>, dirty boolean, sides string")


def sides_of(branches: DataFrame) -> DataFrame:
    """branches: node, state, cluster -> node, sides: the rows of a node as JSON."""
    return branches.groupBy("node").agg(F.to_json(F.sort_array(F.collect_list(F.struct("state", "cluster")))).alias("sides"))


def large_of(contexts: DataFrame, most: int = LARGE) -> DataFrame:
    """contexts: scope, a row for each context -> scope, lots: scopes with more than most contexts, and how many lots these make. There
    is one such scope for most contexts of the table at best, so they can be broadcast."""
    return contexts.where("scope is not null").groupBy("scope").agg(F.ceil(F.count("*") / most).cast("int").alias("lots")).where("lots > 1")


# --- whole scopes ----------------------------------------------------------------------------------------------------


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """A number for each value, -1 for null, and the values by number."""
    coded = column.combine_chunks().dictionary_encode()
    return coded.indices.cast(pa.int64()).fill_null(-1).to_numpy(), coded.dictionary


def _sorted_codes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, list]:
    """The same for texts, numbered in the order of their bytes."""
    codes, values = _codes(column if isinstance(column, pa.ChunkedArray) else pa.chunked_array([column]))
    texts = values.to_pylist()
    order = sorted(range(len(texts)), key=lambda i: texts[i].encode())
    rank = np.empty(len(texts) + 1, np.int64)
    rank[order], rank[-1] = np.arange(len(texts)), -1
    return rank[codes], [texts[i] for i in order]


def _each(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts of things: the owner of each thing, and its number there."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


class _Lists:
    """Lists of numbers, end to end."""

    def __init__(self, owner: np.ndarray, values: np.ndarray, n: int):
        self.values, self.edges = values, np.searchsorted(owner, np.arange(n + 1))

    def take(self, of: np.ndarray) -> _Lists:
        owner, step = _each(np.diff(self.edges)[of])
        return _Lists(owner, self.values[self.edges[of][owner] + step], len(of))

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges))

    def where(self, keep: np.ndarray) -> _Lists:
        mine = keep[self.values]
        return _Lists(self.owners()[mine], self.values[mine], len(self.edges) - 1)

    def names(self) -> tuple[np.ndarray, list[tuple]]:
        """A number for each list, equal for equal ones, and the distinct lists."""
        ends, data = pa.py_buffer((self.edges * 4).astype(np.int64).tobytes()), pa.py_buffer(self.values.astype(np.int32).tobytes())
        coded = pa.Array.from_buffers(pa.large_binary(), len(self.edges) - 1, [None, ends, data]).dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), [tuple(np.frombuffer(x, np.int32).tolist()) for x in coded.dictionary.to_pylist()]


def _nodes(scope: np.ndarray, node: np.ndarray, words: _Lists, dirty: np.ndarray, n_words: int) -> tuple:
    """The nodes of one side: first line, scope, node, words, dirty. Lines without a node are none's."""
    many, there = node.max(initial=0) + 1, np.flatnonzero(node >= 0)
    names, first, at = np.unique(scope[there] * many + node[there], return_index=True, return_inverse=True)
    mine = words.take(there)
    told = np.unique(at[mine.owners()] * n_words + mine.values)
    bad = np.bincount(at, dirty[there], len(names)) > 0
    return there[first], names // many, names % many, _Lists(told // n_words, told % n_words, len(names)), bad


class _Side:
    """Profiles of one side: nodes of a scope that are described alike. of: the profile of each node."""

    def __init__(self, scope: np.ndarray, words: _Lists, dirty: np.ndarray, state: np.ndarray, texts: list[str]):
        prof, lists = words.names()
        key = ((scope * max(len(lists), 1) + prof) * 2 + dirty) * (state.max(initial=0) + 1) + state
        _, first, self.of, self.n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        self.scope, self.dirty, self.state, self.words = scope[first], dirty[first], state[first], words.take(first)
        self.texts, self.lists, self.prof = texts, lists, prof[first]
        has = lambda f: np.array([f(x) for x in texts], bool)
        any_ = lambda keep: np.diff(self.words.where(keep).edges) > 0
        self.free, self.labelled = any_(has(lambda x: x == "0label_free")), any_(has(lambda x: x == "0reporter"))
        self.reporter = any_(has(lambda x: x.startswith("1tmt")))
        kept = {"modality": has(lambda x: x[0] == "0" and x != "0unresolved"), "chemistry": has(lambda x: x[0] == "1"), "acquisition": has(lambda x: x[0] == "2")}
        self.sets = {k: self.words.where(x).names() for k, x in kept.items()}
        self.some = {k: any_(x) for k, x in kept.items()}
        self.channels = self.words.where(has(lambda x: x[0] == "3"))

    def profiles(self) -> pa.Array:
        """The text of each profile, as `alignment` writes it."""
        marked = [(x[0], re.sub(r"([,|\\])", r"\\\1", x[1:])) for x in self.texts]
        texts = ["|".join([",".join([marked[w][1] for w in ws if marked[w][0] == i]) for i in "0123"]) for ws in self.lists]
        return pa.array(texts, pa.string()).take(pa.array(self.prof))


_ABOVE = {k: {k, *itertools.takewhile(bool, itertools.accumulate(itertools.repeat(k), lambda x, _: tech.BELONGS_TO.get(x, "")))} for k in tech.BELONGS_TO}


def _shared(kind: str, x: list[str], y: list[str]) -> list[str]:
    """Words of either side that the other has; of chemistries also those above or below one of the other's."""
    if kind != "chemistry":
        return sorted(set(x) & set(y), key=str.encode)
    met = lambda a, bs: any(a in _ABOVE.get(b, {b}) or b in _ABOVE.get(a, {a}) for b in bs)
    return sorted({*(a for a in x if met(a, y)), *(b for b in y if met(b, x))}, key=str.encode)


class _Met:
    """What the sets of a kind of two profiles share: whether anything, and as text. Each pair of sets is looked at once."""

    def __init__(self, kind: str, c: _Side, b: _Side, texts: list[str]):
        (self.c, cs), (self.b, bs) = c.sets[kind], b.sets[kind]
        self.kind, self.width, self.size, self.known = kind, max(len(bs), 1), len(cs) * len(bs), {}
        self.cs, self.bs = ([[texts[w][1:] for w in ws] for ws in x] for x in (cs, bs))

    def of(self, ci: np.ndarray, bi: np.ndarray) -> tuple[np.ndarray, list, np.ndarray]:
        """Whether pairs share anything; what distinct pairs of sets share, and the number of each pair there."""
        pairs = self.c[ci] * self.width + self.b[bi]
        if self.size <= len(pairs):
            there = np.zeros(self.size, bool)
            there[pairs] = True
            names, at = np.flatnonzero(there), (np.cumsum(there) - 1)[pairs]
        else:
            names, at = np.unique(pairs, return_inverse=True)
        made = []
        for p in names.tolist():
            if p not in self.known:
                x = _shared(self.kind, self.cs[p // self.width], self.bs[p % self.width])
                self.known[p] = f"{self.kind}:" + ",".join(x) if x else None
            made.append(self.known[p])
        return np.array([m is not None for m in made], bool)[at], made, at


class _Channels:
    """Bits of the channels of both sides: of a scope, each tag is a bit, and the roles that it has there lie in planes."""

    def __init__(self, c: _Side, b: _Side, texts: list[str]):
        self.tags, names = _sorted_codes(pa.array([x.rpartition(":")[2] if x[0] == "3" else "" for x in texts], pa.string()))
        self.tag_names, self.n_words, self.n_tags = names, len(texts), len(names)
        held = [(s, s.scope[s.channels.owners()], s.channels.values) for s in (c, b)]
        # the words of a scope in order of tags, then its tags
        key = lambda scope, w: (scope * self.n_tags + self.tags[w]) * self.n_words + w
        words = np.unique(np.concatenate([key(scope, w) for _, scope, w in held]))
        tags, first, of = np.unique(words // self.n_words, return_index=True, return_inverse=True)
        plane = np.arange(len(words)) - first[of]
        start = np.searchsorted(tags // max(self.n_tags, 1), np.arange(max(c.scope.max(initial=0), b.scope.max(initial=0)) + 2))
        bit = np.arange(len(tags)) - start[tags // max(self.n_tags, 1)]
        self.size = np.maximum(-(-np.diff(start) // 64), 1)  # of a scope: 64-bit numbers a plane
        self.planes = np.ones(len(self.size), np.int64)
        np.maximum.at(self.planes, tags[of] // max(self.n_tags, 1), plane + 1)
        at = [np.searchsorted(words, key(scope, w)) for _, scope, w in held]
        self.bits = [(s, s.channels.owners(), plane[a], bit[of[a]]) for (s, _, _), a in zip(held, at)]

    def within(self, side: int, first: int, last: int, planes: int, size: int) -> np.ndarray:
        """planes x profiles x size: the bits of a side's profiles first..last."""
        s, owner, plane, bit = self.bits[side]
        lo, hi = np.searchsorted(owner, [first, last])
        out = np.zeros((planes, last - first, size), np.uint64)
        np.bitwise_or.at(out, (plane[lo:hi], owner[lo:hi] - first, bit[lo:hi] // 64), np.uint64(1) << (bit[lo:hi] % 64).astype(np.uint64))
        return out


class _Scopes:
    """All that is known of the scopes of a task."""

    def __init__(self, table: pa.Table):
        scope, self.scopes = _codes(table.column("scope"))
        flat = table.column("words").combine_chunks()
        words, self.texts = _sorted_codes(flat.flatten())
        counts = pc.list_value_length(flat).to_numpy()
        words, dirty = _Lists(np.repeat(np.arange(len(counts)), counts), words, len(counts)), table.column("dirty").to_numpy().astype(bool)
        self.n = max(len(self.texts), 1)
        node, self.nodes = _codes(table.column("context"))
        _, self.c_scope, self.c_node, told, bad = _nodes(scope, node, words, dirty, self.n)
        some = np.flatnonzero(np.diff(told.edges))
        self.c_scope, self.c_node = self.c_scope[some], self.c_node[some]
        self.c = _Side(self.c_scope, told.take(some), bad[some], np.zeros(len(some), np.int64), self.texts)
        line, of, _, told, bad = _nodes(scope, _codes(table.column("branch"))[0], words, dirty, self.n)
        sides, made = _codes(table.column("sides"))
        rows = [[(x.get("state", ""), x.get("cluster")) for x in json.loads(t)] for t in made.to_pylist()] + [[]]  # the last: of no side
        node, step = _each(np.array([len(r) for r in rows])[sides[line]])
        flat = list(itertools.chain.from_iterable(rows))
        at = np.cumsum([0, *map(len, rows)])[sides[line]][node] + step
        state, self.states = _sorted_codes(pa.array([s for s, _ in flat], pa.string()))
        cluster, self.clusters = _sorted_codes(pa.array([c for _, c in flat], pa.string()))
        b = self.b = _Side(of[node], told.take(node), bad[node], state[at], self.texts)
        self.least, self.greatest = np.full(len(b.n), len(self.clusters)), np.full(len(b.n), -1)
        cluster = cluster[at]
        np.maximum.at(self.greatest, b.of, cluster)
        np.minimum.at(self.least, b.of, np.where(cluster < 0, len(self.clusters), cluster))
        self.met = {k: _Met(k, self.c, b, self.texts) for k in al.SHARED}
        self.channels = _Channels(self.c, b, self.texts)
        self.first = np.searchsorted(b.scope, np.arange(len(self.scopes) + 1))  # of a scope: its branches' profiles
        self.role = pa.array([x[1:] for x in self.texts], pa.string())

    def blocks(self) -> Iterator[tuple[int, int]]:
        """Contexts' profiles first..last whose pairs are a block; scopes of one size of bits lie in a block."""
        many = np.diff(self.first)[self.c.scope]
        size, at, n = self.channels.size[self.c.scope], 0, 0
        for i, m in enumerate(many.tolist()):
            if i > at and (n + m > PAIRS // int(size[at]) or size[i] != size[at]):
                yield at, i
                at, n = i, 0
            n += m
        if len(many):
            yield at, len(many)

    def pairs(self, first: int, last: int) -> dict:
        """The pairs of a block: profiles c and b, what both share and what contradicts, scores, and status by number."""
        c, b = self.c, self.b
        many = np.diff(self.first)[c.scope[first:last]]
        row, step = _each(many)
        ci, bi = row + first, self.first[c.scope[first:last]][row] + step
        out = {"c": ci, "b": bi, "row": row}
        met = {k: x.of(ci, bi) for k, x in self.met.items()}
        out["met"] = met
        low, high = (int(bi.min()), int(bi.max()) + 1) if len(bi) else (0, 0)
        scopes = slice(int(c.scope[first]), int(c.scope[last - 1]) + 1)
        planes, size = int(self.channels.planes[scopes].max()), int(self.channels.size[scopes].max())
        of_c, of_b = self.channels.within(0, first, last, planes, size), self.channels.within(1, low, high, planes, size)
        held = [x[row] & y[bi - low] for x, y in zip(of_c, of_b)]
        roles = sum(np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in held)
        both = np.bitwise_or.reduce(of_c)[row] & np.bitwise_or.reduce(of_b)[bi - low]
        for x in held:
            both &= ~x
        taken = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
        out |= {"roles": roles, "taken": taken}
        two = {k: c.some[k][ci] & b.some[k][bi] for k in al.SHARED}
        two["chemistry"] = c.reporter[ci] & b.reporter[bi]
        two["modality"] &= (c.free[ci] | b.free[bi]) & (c.labelled[ci] | b.labelled[bi])
        clash = out["clash"] = {k: two[k] & ~met[k][0] for k in al.SHARED}
        score = sum(v * met[k][0] for k, v in al.SHARED.items()) + np.minimum(al.SHARED_ROLES, al.SHARED_ROLE * roles)
        against = sum(v * clash[k] for k, v in al.AGAINST.items()) + np.minimum(al.ROLES_AGAINST, al.ROLE_AGAINST * taken)
        state = {s: i for i, s in enumerate(self.states)}
        is_ = lambda s: b.state[bi] == state.get(s, -1)
        eligible = (score >= al.CLEAN) & (against < al.CONTRADICTORY) & ~c.dirty[ci] & ~b.dirty[bi] & is_("canonical_branch_candidate")
        none = len(self.clusters)
        least, greatest = np.full(last - first, none), np.full(last - first, -1)
        np.minimum.at(least, row[eligible], self.least[bi[eligible]])
        np.maximum.at(greatest, row[eligible], self.greatest[bi[eligible]])
        one = eligible & (least == greatest)[row]
        ladder = [
            (b.dirty[bi] | is_("contradictory_hypothesis"), "branch_contradictory"), (against >= al.CONTRADICTORY, "contradictory"), (c.dirty[ci] & (score >= al.WEAK), "context_conflicted_candidate"),
            (is_("unresolved_hypothesis") & (score >= al.WEAK), "branch_unresolved_candidate"), (one, "unique_compatible_candidate"), (eligible, "ambiguous_compatible_candidate"), (score >= al.WEAK, "weak_candidate"),
        ]
        status = np.select([x for x, _ in ladder], [al.STATUSES.index(s) for _, s in ladder], al.STATUSES.index("insufficient_evidence"))
        return out | {"score": score, "against": against, "status": status, "cluster": np.where(one, least[row], -1), "found": np.where(least == greatest, least, -1)}

    def _joined(self, n: int, pair: np.ndarray, order: np.ndarray, texts: pa.Array, mark: str) -> pa.Array:
        """For each of n pairs its texts in order, joined; null where it has none."""
        at = np.lexsort((order, pair))
        counts = np.bincount(pair, minlength=n)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), texts.take(pa.array(order[at])))
        return pc.if_else(pa.array(counts > 0), pc.binary_join(lists, mark), pa.scalar(None, pa.string()))

    def said(self, x: dict) -> tuple[pa.Array, pa.Array]:
        """What pairs share, and what of them contradicts, as texts."""
        n = len(x["c"])
        some = np.flatnonzero(x["roles"] > 0)
        words = self.c.channels.take(x["c"][some])
        theirs = self.b.channels.take(x["b"][some])
        name = lambda y: y.owners() * self.n + y.values
        roles = np.intersect1d(name(words), name(theirs), assume_unique=True)
        roles = self._joined(n, some[roles // self.n], roles % self.n, self.role, ";")
        matched = _together(*(_named(made, at) for _, made, at in x["met"].values()), roles)
        some = np.flatnonzero(x["taken"] > 0)
        tags = self.channels.tags
        words, theirs = self.c.channels.take(x["c"][some]), self.b.channels.take(x["b"][some])
        many = self.channels.n_tags
        both = np.intersect1d(name(words), name(theirs), assume_unique=True)
        held = np.unique(both // self.n * many + tags[both % self.n])
        tag = lambda y: np.unique(y.owners() * many + tags[y.values])
        taken = np.setdiff1d(np.intersect1d(tag(words), tag(theirs), assume_unique=True), held, assume_unique=True)
        taken = self._joined(n, some[taken // max(many, 1)], taken % max(many, 1), pa.array([f"reporter_role:{t}" for t in self.channels.tag_names], pa.string()), ";")
        against = {"modality": "label_free_vs_reporter_modality", "chemistry": "incompatible_reporter_chemistry", "acquisition": "different_acquisition"}
        clashes = [pa.array([None, t], pa.string()).take(pa.array(x["clash"][k].astype(np.int64))) for k, t in against.items()]
        return matched, _together(*clashes, taken)


def _together(*texts: pa.Array) -> pa.Array:
    """Texts side by side, joined by semicolons without those that are null."""
    marked = [pc.binary_join_element_wise("", t, ";").fill_null("") for t in texts]
    return pc.utf8_slice_codeunits(pc.binary_join_element_wise(*marked, ""), 1)


def _named(values: list, at: np.ndarray) -> pa.Array:
    """Texts by number, null below 0."""
    return pa.array(values, pa.string()).take(pa.array(at, mask=at < 0))


def _grouped(lines: DataFrame, stated: Mapping[str, str], large: DataFrame, parts: int, made, schema: str) -> DataFrame:
    scope, context = (lines.schema[c].dataType.simpleString() for c in ("scope", "context"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from made(_Scopes(pa.Table.from_batches(list(batches))))

    # each lot has all branches, and of the contexts its own: elsewhere a line has none
    lots = told(lines, stated).join(F.broadcast(large), "scope", "left").withColumn("lot", F.explode(F.sequence(F.lit(0), F.coalesce("lots", F.lit(1)) - 1)))
    own = F.pmod(F.hash("context"), F.coalesce("lots", F.lit(1))) == F.col("lot")
    of = lots.select("scope", F.when(own, F.col("context")).alias("context"), "branch", "words", "dirty", "sides", F.pmod(F.hash("scope", "lot"), F.lit(parts)).alias("part"))
    return of.groupBy("part").applyInArrow(each, schema.format(scope=scope, context=context))


def alignments(lines: DataFrame, stated: Mapping[str, str], large: DataFrame, parts: int) -> DataFrame:
    """lines and stated as told() takes them, large as large_of() gives it, the number of groups of scopes -> what alignment.profile_alignments() gives, a row for each pair of profiles of a scope."""

    def made(of: _Scopes):
        c, b = of.c, of.b
        c_profile, b_profile = c.profiles(), b.profiles()
        for first, last in of.blocks():
            x = of.pairs(first, last)
            ci, bi = x["c"], x["b"]
            columns = {
                "scope": of.scopes.take(pa.array(c.scope[ci])), "c_profile": c_profile.take(pa.array(ci)), "c_dirty": pa.array(c.dirty[ci]), "c_n": pa.array(c.n[ci], pa.int64()), "b_profile": b_profile.take(pa.array(bi)),
                "b_dirty": pa.array(b.dirty[bi]), "b_state": _named(of.states, b.state[bi]), "b_n": pa.array(b.n[bi], pa.int64()), "score": pa.array(x["score"] / 100), "conflict_score": pa.array(x["against"] / 100),
            }
            columns["matched"], columns["conflicts"] = of.said(x)
            columns |= {"status": _named(list(al.STATUSES), x["status"]), "cluster": _named(of.clusters, x["cluster"])}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "scope {scope}, c_profile string, c_dirty boolean, c_n long, b_profile string, b_dirty boolean, b_state string, b_n long, score double, conflict_score double, matched string, conflicts string, status string, cluster string"
    return _grouped(lines, stated, large, parts, made, schema)


def choices(lines: DataFrame, stated: Mapping[str, str], large: DataFrame, parts: int) -> DataFrame:
    """lines and stated as told() takes them, large as large_of() gives it, the number of groups of scopes -> what alignment.choices() gives, a row for each context with a feature."""
    kinds = {"n_compatible": al.STATUSES[:2], "n_weak": al.STATUSES[2:5], "n_contradictory": al.STATUSES[5:7]}

    def made(of: _Scopes):
        n = len(of.c.n)
        top, cluster, sums = np.full(n, len(al.STATUSES) * 1000 + 1000), np.full(n, -1), {k: np.zeros(n, np.int64) for k in kinds}
        for first, last in of.blocks():
            x = of.pairs(first, last)
            np.minimum.at(top, x["c"], (x["status"] + 1) * 1000 - x["score"])
            cluster[first:last] = x["found"]
            for k, names in kinds.items():
                mine = np.isin(x["status"], [al.STATUSES.index(s) for s in names])
                sums[k][first:last] = np.bincount(x["row"][mine], of.b.n[x["b"][mine]], last - first).astype(np.int64)
        best = -(-top // 1000)  # one more than there are statuses: no branch
        there, at = best <= len(al.STATUSES), of.c.of
        score = pa.array((best * 1000 - top) / 100, mask=~there)
        status = _named([*al.STATUSES, "no_branch"], best - 1)
        columns = {"scope": of.scopes.take(pa.array(of.c_scope)), "node": of.nodes.take(pa.array(of.c_node))}
        columns |= {k: x.take(pa.array(at)) for k, x in (("status", status), ("score", score), ("cluster", _named(of.clusters, cluster)))}
        columns |= {k: pa.array(x[at]) for k, x in sums.items()}
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return _grouped(lines, stated, large, parts, made, "scope {scope}, node {context}, status string, score double, cluster string, n_compatible long, n_weak long, n_contradictory long")
