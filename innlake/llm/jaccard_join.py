"""Exact Jaccard self-join of documents on word shingles, by rare-first prefixes.

Two sets with Jaccard similarity t or more share a token among their first n - ceil(t n) + 1 tokens in any
order that both follow. Tokens are ordered by the number of sets that hold them, the rarest first, ties by their code. The numbers
come from one shuffle: every task sorts the tokens of its distinct sets and sends them packed by range of codes, and the range answers, for
each set, with the tokens that another set holds as well and their numbers. Tokens that many sets of a single task hold are
counted in the tasks before; the most frequent of these are told to all tasks and not sent (a stated number of them, which
decides only how a token is counted). The order does not depend on the number of tasks but for such tokens' numbers, and
the links do not depend on the order at all.

A prefix token that no other set holds meets nothing and is left out, so most sets have no prefix row. Sets that are equal are one node
from the start. A node is first compared with one node of each of its token groups (a star, not all pairs; few groups have the same
one); only pairs that are not in one component after that, one of them outside its token's largest component, are compared one by one. Pairs pass the length filter, the positional filter and a suffix filter (parities of the token counts by code
range, which bound how many tokens the sets do not share) before the sets themselves are compared, once per pair.

Defined results: null and empty texts, and texts without a word, have no shingle and link with nothing;
fewer words than the shingle length make one shingle of all; repeated rows are linked unless empty; rows with
one id each keep their row; a null id stays, and never names a component that holds another id. Very long texts are taken whole, one
at a time. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innlake.llm.arrowtext import SPACES, list_array, mixed, row_chunks, sequence_codes, text_buffers, words_of
from innlake.llm.components import components
from innlake.llm.workspace import saved

WORDS = 5
PERCENT = 75
#: Bits of a token that travel, and text bytes for each range of them.
TOKEN_BITS = 55
RANGE_BYTES = 32 << 20
#: Tokens that wait in a task to be counted, and to be packed.
TALLY = 1 << 19
PACKED = 1 << 19
#: A token of so many sets of one task is counted by tasks; the most frequent of these, at most LISTED_TOKENS, are sent to all.
OFTEN = 8
LISTED_TOKENS = 1 << 18
RANGE_BITS = 10
LISTED = 64
MEMBERS = 256
#: Orders by chance in which a token's first node is its hub: one alone may be far from most near copies, which then all meet pairwise.
HUBS = 4
PARITIES = [f"p{k}" for k in range((1 << RANGE_BITS) // 64)]
FOUND = pa.schema([("code", pa.int64()), ("n", pa.int32()), ("size", pa.int32()), ("entries", pa.list_(pa.int64()))])
NO_ID = -(2**63)
BROADCAST_ROWS = 500_000

SIGNATURE = "doc_id long, text_code long, code long, n int, parity array<long>, token long, times long"
PACKS = "part int, code long, n int, size int, entries array<long>, tokens binary, owners binary, codes binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, length: int) -> list[np.ndarray]:
    """The sorted distinct shingle codes of each text."""
    words = words_of(data, offsets, SPACES)
    runs = sequence_codes(words.codes, length)
    out = []
    for first, last in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if last - first >= length:
            out.append(np.unique(runs[first : last - length + 1]))
        else:
            out.append(sequence_codes(words.codes[first:last], last - first) if last > first else runs[:0])
    return out


def _set_code(tokens: np.ndarray) -> int:
    """A code of a set, whatever its order."""
    return int(mixed(tokens).sum(dtype=np.uint64).astype(np.uint64).view(np.int64))


class _Tally:
    """Tokens of a task with their numbers; single ones are dropped whenever TALLY of them wait."""

    def __init__(self):
        self.tokens, self.times = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.waiting, self.size = [], 0

    def add(self, tokens: np.ndarray) -> None:
        self.waiting.append(tokens)
        self.size += len(tokens)
        if self.size >= TALLY:
            self.settle()

    def settle(self) -> None:
        tokens = np.concatenate([self.tokens, *self.waiting])
        times = np.concatenate([self.times, np.ones(self.size, np.int64)])
        found, index = np.unique(tokens, return_inverse=True)
        times = np.bincount(index, times, len(found)).astype(np.int64)
        self.tokens, self.times = found[times > 1], times[times > 1]
        self.waiting, self.size = [], 0

    def frequent(self) -> tuple[np.ndarray, np.ndarray]:
        self.settle()
        many = self.times >= OFTEN
        return self.tokens[many], self.times[many]


def _signer(length: int):
    """A signature row per document, and at the end of a task a row for each token that OFTEN of its sets hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, met = _Tally(), set()
        for batch in batches:
            data, offsets = text_buffers(batch.column(2))
            code, size, parity = [], [], []
            for low, high in row_chunks(offsets):
                for tokens in shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], length):
                    code.append(_set_code(tokens))
                    size.append(len(tokens))
                    bits = np.bincount((tokens >> np.uint64(64 - RANGE_BITS)).astype(np.int64), minlength=1 << RANGE_BITS) & 1
                    parity.append(np.packbits(bits.astype(np.uint8)).view(np.int64))
                    if code[-1] not in met:
                        met.add(code[-1])
                        tally.add(tokens)
            bounds = np.arange(len(size) + 1) * ((1 << RANGE_BITS) // 64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(code, pa.int64()), pa.array(size, pa.int32()),
                list_array(pa.array(np.concatenate(parity) if parity else [], pa.int64()), bounds), pa.nulls(len(size), pa.int64()), pa.nulls(len(size), pa.int64()),
            ], names=["doc_id", "text_code", "code", "n", "parity", "token", "times"])
        tokens, times = tally.frequent()
        none = [pa.nulls(len(tokens), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*none, pa.array(tokens.view(np.int64)), pa.array(times)], names=["doc_id", "text_code", "code", "n", "parity", "token", "times"])

    return run


def _frequent(signed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(rising tokens, frequencies) of at most LISTED_TOKENS that stand out in single tasks; these need not be sent to be counted."""
    counted = signed.where("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
    rows = counted.orderBy(F.desc("times"), "token").limit(LISTED_TOKENS).toArrow()
    tokens, times = rows.column("token").to_numpy().view(np.uint64), rows.column("times").to_numpy()
    order = np.argsort(tokens)
    return tokens[order], times[order]


def _entry(tokens: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Order keys: the frequency's class, an eighth of an octave wide, before the token's first TOKEN_BITS bits."""
    kind = np.minimum(255, 8 * np.log2(times)).astype(np.uint64)
    return (kind << np.uint64(TOKEN_BITS) | tokens).view(np.int64)


def _dealer(length: int, bits: int, frequent: np.ndarray, times: np.ndarray):
    """The tokens of a task's distinct sets, sorted and packed by range; a row per set has its size and its frequent tokens.

    A pack holds the tokens' bytes below the range, plane by plane, the sets' codes, and each token's place among them.
    """
    names = ["part", "code", "n", "size", "entries", "tokens", "owners", "codes"]
    lower = np.uint64(TOKEN_BITS - bits)
    planes = -(-(TOKEN_BITS - bits) // 8)

    def about(code, n, size, entries):
        bounds = np.concatenate(([0], np.cumsum([len(e) for e in entries])))
        rows, flat = len(code), np.concatenate(entries) if entries else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(np.arange(rows) & (1 << bits) - 1, pa.int32()), pa.array(code, pa.int64()), pa.array(n, pa.int32()), pa.array(size, pa.int32()),
            list_array(pa.array(flat, pa.int64()), bounds), *(pa.nulls(rows, pa.binary()) for _ in range(3))], names=names)

    def packs(sets, codes):
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        tokens, owner, codes = tokens[order], owner[order], np.array(codes, np.int64)
        edges = np.searchsorted(tokens >> lower, np.arange((1 << bits) + 1, dtype=np.uint64))
        rows = []
        for part in np.flatnonzero(np.diff(edges)).tolist():
            here = slice(edges[part], edges[part + 1])
            who, place = np.unique(owner[here], return_inverse=True)
            low = (tokens[here] & (np.uint64(1) << lower) - np.uint64(1)).astype("<u8").view(np.uint8).reshape(-1, 8)
            kind = np.uint16 if len(who) <= 1 << 16 else np.uint32
            rows.append((part, np.ascontiguousarray(low[:, :planes].T).tobytes(), place.astype(kind).tobytes(), codes[who].tobytes()))
        part, *packed = zip(*rows)
        none = [pa.nulls(len(rows), t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *none, *(pa.array(p, pa.binary()) for p in packed)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, sets, codes, held = set(), [], [], 0
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            for low, high in row_chunks(offsets):
                rows = []
                for tokens in shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], length):
                    code = _set_code(tokens)
                    if not len(tokens) or code in met:
                        continue
                    met.add(code)
                    at = np.minimum(np.searchsorted(frequent, tokens), max(len(frequent) - 1, 0))
                    often = frequent[at] == tokens if len(frequent) else np.zeros(len(tokens), bool)
                    short = np.uint64(64 - TOKEN_BITS)
                    entries = _entry(tokens[often] >> short, times[at[often]]) if often.any() else np.empty(0, np.int64)
                    rest = np.unique(tokens[~often] >> short)
                    rows.append((code, len(tokens), len(np.unique(tokens >> short)), entries))
                    if len(rest):
                        sets.append(rest)
                        codes.append(code)
                        held += len(rest)
                yield about(*zip(*rows)) if rows else about((), (), (), ())
                if held >= PACKED:
                    yield packs(sets, codes)
                    sets, codes, held = [], [], 0
        if held:
            yield packs(sets, codes)

    return run


def _matcher(bits: int):
    """For every set and range the order keys of the tokens that another set holds as well."""
    planes, lower = -(-(TOKEN_BITS - bits) // 8), np.uint64(TOKEN_BITS - bits)

    def shared(part: int, packs: list) -> Iterator[pa.RecordBatch]:
        """An eighth of the range at a time, to sort little at once."""
        tokens, codes = unpacked(packs)
        eighth = (tokens >> lower - np.uint64(3)).astype(np.uint8)
        for k in range(8):
            yield matched(part, tokens[eighth == k], codes[eighth == k])

    def unpacked(packs: list) -> tuple[np.ndarray, np.ndarray]:
        tokens, codes = [], []
        for packed, owners, known in packs:
            known, size = np.frombuffer(known, np.int64), len(packed) // planes
            owners = np.frombuffer(owners, np.uint16 if len(known) <= 1 << 16 else np.uint32)
            low = np.zeros((size, 8), np.uint8)
            low[:, :planes] = np.frombuffer(packed, np.uint8).reshape(planes, size).T
            tokens.append(low.view("<u8").ravel())
            codes.append(known[owners])
        return np.concatenate(tokens), np.concatenate(codes)

    def matched(part: int, tokens: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        if not len(tokens):
            return pa.RecordBatch.from_pylist([], FOUND)
        order = np.argsort(tokens, kind="stable")
        tokens, codes = tokens[order], codes[order]
        same = tokens[1:] == tokens[:-1]
        several = np.concatenate((same, [False])) | np.concatenate(([False], same))
        tokens, codes = tokens[several], codes[several]
        order = np.lexsort((codes, tokens))
        tokens, codes = tokens[order], codes[order]
        fresh = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (codes[1:] != codes[:-1])))[: len(tokens)]
        tokens, codes = tokens[fresh], codes[fresh]
        _, index, times = np.unique(tokens, return_inverse=True, return_counts=True)
        held = times[index] > 1
        entries, codes = _entry(tokens[held] | np.uint64(part) << lower, times[index[held]]), codes[held]
        order = np.argsort(codes, kind="stable")
        entries, codes = entries[order], codes[order]
        known, first = np.unique(codes, return_index=True)
        return pa.RecordBatch.from_arrays([
            pa.array(known), pa.nulls(len(known), pa.int32()), pa.nulls(len(known), pa.int32()), list_array(pa.array(entries), np.append(first, len(codes)).astype(np.int32)),
        ], names=["code", "n", "size", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, packs = None, []
        for batch in batches:
            known = batch.column("code").is_valid()
            yield batch.filter(known).select(["code", "n", "size", "entries"])
            batch = batch.filter(pc.invert(known))
            columns = [batch.column(c) for c in ("tokens", "owners", "codes")]
            for k, where in enumerate(batch.column("part").to_pylist()):
                if packs and where != part:
                    yield from shared(part, packs)
                    packs = []
                part = where
                packs.append(tuple(c[k].as_py() for c in columns))
        if packs:
            yield from shared(part, packs)

    return run


def prefixes(docs: DataFrame, frequent: np.ndarray, times: np.ndarray, words: int, percent: int, bits: int) -> DataFrame:
    """(token, node, at): the first tokens of every set, rare ones first, but for those no other set holds.

    ``at`` is the place in the order times 2^32, plus the place among the tokens that another set holds; -1 for a set of
    which two tokens agree in their first TOKEN_BITS bits.
    """
    dealt = docs.select("text").mapInArrow(_dealer(words, bits, frequent, times), PACKS)
    dealt = dealt.repartition(2 << bits, "part").sortWithinPartitions("part")
    found = dealt.mapInArrow(_matcher(bits), "code long, n int, size int, entries array<long>")
    # copies of a set in several tasks have equal rows of their own
    sets = found.groupBy("code").agg(F.max("n").alias("n"), F.max("size").alias("size"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("entries")))).alias("entries"))
    alone = F.col("size") - F.size("entries")
    kept = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    first = F.slice("entries", F.lit(1), F.greatest(kept - F.col("alone"), F.lit(0)).cast("int"))
    rows = sets.withColumn("alone", alone).select("code", "n", "size", "alone", F.posexplode(first).alias("pos", "entry"))
    return rows.select(
        F.col("entry").bitwiseAND(F.lit((1 << TOKEN_BITS) - 1)).alias("token"), _node(),
        F.when(F.col("size") == F.col("n"), F.expr("(alone + pos) * 4294967296L + pos")).otherwise(-1).alias("at"))


def _comparer(length: int, percent: int):
    """Pairs of a centre and a member that are similar enough; a centre's text comes before its members'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = np.empty(0, np.uint64)
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            leads, keep = batch.column("leads").to_pylist(), []
            for low, high in row_chunks(offsets):
                sets = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], length)
                for row, tokens in zip(range(low, high), sets):
                    if leads[row]:
                        centre = tokens
                        continue
                    both = len(np.intersect1d(centre, tokens, assume_unique=True))
                    if 100 * both >= percent * (len(centre) + len(tokens) - both):
                        keep.append(row)
            yield batch.take(pa.array(keep, pa.int64())).select(["a", "b"])

    return run


def _node():
    return F.struct("n", "code").alias("node")


def _shared(rows: DataFrame) -> DataFrame:
    """The prefix rows (token, node, at) of tokens with several nodes; of tokens with the same nodes one is kept.

    Near copies share dozens of tokens with the same holders.
    """
    holders = rows.groupBy("token").agg(F.bit_xor(F.xxhash64("node")).alias("all"), F.count("*").alias("rows"), F.min("node").alias("low"), F.max("node").alias("high"))
    once = holders.where("low != high").groupBy("all", "rows", "low", "high").agg(F.min("token").alias("token")).select("token")
    return rows.join(once, "token")


def _possible(rows: DataFrame, percent: int, once: Column | str = "true") -> DataFrame:
    """Distinct pairs (a, b) that pass three filters; rows have a, a_at, a_p0 .., b, b_at, b_p0 ..

    Length: the smaller set is large enough. Position: the common token leaves enough tokens that both may hold; before it, these
    are among those that another set holds. Suffix: each code range whose token counts differ in parity holds a token that one set has
    and the other lacks. Of a join's rows only those that pass are made, as its condition; ``once`` is tested last.
    """
    a, b = F.col("a.n"), F.col("b.n")
    need = F.ceil(F.lit(percent) * (a + b) / F.lit(100 + percent))
    after = F.least(a - F.shiftright("a_at", 32), b - F.shiftright("b_at", 32))
    before = F.least(F.col("a_at").bitwiseAND(F.lit(0xFFFFFFFF)), F.col("b_at").bitwiseAND(F.lit(0xFFFFFFFF)))
    close = (after + before >= need) | (F.least("a_at", "b_at") < 0)
    odd = reduce(Column.__add__, [F.bit_count(F.col(f"a_{p}").bitwiseXOR(F.col(f"b_{p}"))) for p in PARITIES])
    near = odd <= a + b - 2 * need
    return rows.where((100 * F.least(a, b) >= percent * F.greatest(a, b)) & close & near).where(once).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _verified(near: DataFrame, docs: DataFrame, signatures: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough.

    One text of each node travels to the pairs' first nodes, its centres, and is compared there; a centre with very many
    members has several places, each with its own copy of the centre's text.
    """
    places = near.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).alias("places"))
    members = near.join(places, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("places")).alias("place"))
    routes = members.withColumn("leads", F.lit(False)).unionByName(
        members.select("a", F.col("a").alias("b"), "place", F.lit(True).alias("leads")).distinct())
    holders = signatures.groupBy("n", "code").agg(F.min(F.struct("text_code", "doc_id")).alias("holder")).select(_node().alias("b"), "holder.*")
    routes = saved(routes.join(holders, "b"))
    few = routes.count() <= BROADCAST_ROWS
    texts = docs.join(F.broadcast(routes) if few else routes, ["doc_id", "text_code"]).select("a", "b", "place", "leads", "text")
    sent = texts.repartition("a", "place").sortWithinPartitions("a", "place", F.desc("leads"))
    pair = "struct<n:int,code:long>"
    return sent.mapInArrow(_comparer(words, percent), f"a {pair}, b {pair}")


def _range_bits(docs: DataFrame) -> int:
    """Token ranges, as a power of two: one for every 32 MB of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(20, max(6, (size // RANGE_BYTES).bit_length()))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links), text_code, component.

    ``text_code`` is the text's xxhash64, ``component`` tells components apart that rows with equal ids name alike.
    """
    text = F.col(text_col).cast("string")
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64(text).alias("text_code"), text.alias("text"))
    signed = saved(docs.mapInArrow(_signer(words), SIGNATURE))
    signatures = signed.where("n is not null").drop("token", "times")
    shared = saved(_shared(saved(prefixes(docs, *_frequent(signed), words, percent, _range_bits(docs)))))
    involved = shared.select("node").distinct()
    parities = (F.get("parity", F.lit(k)).alias(p) for k, p in enumerate(PARITIES))  # as columns, for fast conditions of joins
    info = signatures.select(_node(), *parities).join(involved, "node", "left_semi").dropDuplicates(["node"])
    shared = saved(shared.join(info, "node"))
    verified = lambda pairs: saved(_verified(pairs, docs, signatures, words, percent))

    def linked(rows: DataFrame, once: Column | str = "true") -> DataFrame:
        """Links that join what the possible pairs can join: each node's first pair is compared, then what these leave apart."""
        near = saved(_possible(rows, percent, once))
        one = near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        links = verified(one)
        joined = saved(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
        named = lambda c: joined.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in"))
        apart = F.coalesce("a_in", "a") != F.coalesce("b_in", "b")
        rest = near.join(one, ["a", "b"], "left_anti").join(named("a"), "a", "left").join(named("b"), "b", "left").where(apart).select("a", "b")
        return links.unionByName(verified(saved(rest)))

    def grouped(links: DataFrame) -> DataFrame:
        """The shared rows of tokens with several components so far, with their own component and the token's largest one."""
        named = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        named = saved(shared.join(named, "node", "left").withColumn("component", F.coalesce("component", "node")))
        mains = named.groupBy("token", "component").count().groupBy("token").agg(
            F.max_by("component", F.struct("count", "component")).alias("main"), F.count("*").alias("kinds")).where("kinds > 1")
        return named.join(mains.drop("kinds"), "token")

    def star(rows: DataFrame) -> DataFrame:
        """Every row beside one node of its token; tokens have HUBS different ones where they have the same nodes."""
        chance = F.xxhash64("node", F.pmod("token", F.lit(HUBS)))
        hubs = rows.groupBy("token").agg(F.min_by(F.struct("node", "at", *PARITIES), chance).alias("hub"))
        return rows.join(hubs, "token").where("node != hub.node").select(
            F.col("hub.node").alias("a"), F.col("node").alias("b"), *(F.col(f"hub.{c}").alias(f"a_{c}") for c in ("at", *PARITIES)),
            *(F.col(c).alias(f"b_{c}") for c in ("at", *PARITIES)))

    links = linked(star(shared))
    sides = grouped(links)

    # a pair is made under the least of its common tokens, unless one of its nodes has too many of them to be told with each row
    listed = shared.groupBy("node").agg(F.collect_list("token").alias("tokens")).where(F.size("tokens") <= LISTED)
    sides = saved(sides.join(listed, "node", "left"))
    strays = sides.where("component != main")
    columns = ("node", "at", *PARITIES, "component", "tokens")
    left = strays.select("token", *(F.col(c).alias(f"a_{c}") for c in columns)).withColumnRenamed("a_node", "a")
    right = sides.select("token", *(F.col(c).alias(f"b_{c}") for c in columns), "main").withColumnRenamed("b_node", "b")
    across = left.join(right, "token").where((F.col("a_component") != F.col("b_component")) & ((F.col("b_component") == F.col("main")) | (F.col("a") < F.col("b"))))
    first = F.array_min(F.array_intersect("a_tokens", "b_tokens"))
    links = links.unionByName(linked(across, first.isNull() | (first == F.col("token"))))

    classes_of = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    known = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    rows = signatures.select(known.alias("doc_id"), "text_code", "n", _node()).join(classes_of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = rows.groupBy("component").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "component")
    return out.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        "text_code", "component")
