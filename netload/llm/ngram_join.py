"""N-gram Jaccard join: which documents are near copies, and the classes they form.

A document's set holds its distinct shingles (a shorter text is one shingle).
Two documents link when ``100 * |A & B| >= percent * |A | B|``. The classes are
exact: every link between different sets is found, up to equal 64-bit hashes of
different shingles.

Method: token-combination prefixes. Shingles have a fixed order, rare before
frequent. Two sets that link share at least ``t`` shingles within their first
``size - least overlap + t``. A frequent shingle is indexed in pairs with each other
frequent one there, a rare shingle alone. Sets from ``LONG`` shingles on index every
prefix shingle alone, and sets up to ``LONG * 100 / percent`` index both ways, so any two
that can link have their forms in common: at least ``t - 1`` of them.

Prefixes are extended for the sake of that number: ``t`` is 2 and a tenth of the size. A set of
which fewer forms stand in lists with other sets has no link and goes no further, so
texts that share a passage alone are not compared. Lists of very frequent shingles are known beforehand from
counts and take a way of their own, an aggregate and a join, which Spark combines and splits.

No pair of a posting list is ever emitted. Each list names its smallest set as
centre, sets that share a centre form a group, and a group is verified as a
whole: a search that follows verified links, counts overlaps through postings and
never compares two sets already known to be connected. Two sets that share a list
share its centre, so no link is lost. Groups beyond ``GROUP_SETS`` sets or
``GROUP_SHINGLES`` are cut into blocks and every pair of blocks is one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from netload.llm.components import components
from netload.llm.schema import documents, kept, only_text
from netload.llm.wordhash import gram_starts, mix, slices, words

#: Shingles counted as frequent: at most this many (8 bytes each go to every task) ...
FREQUENT_MAX = 1 << 17
#: ... and each at least this often, as counted within map tasks.
FREQUENT_LEAST = 32
#: Sets of this many shingles or more are indexed by single shingles only.
LONG = 200
#: Lists of shingles counted more often than this are grouped without a window.
HOT = 4096
#: What a block of a group holds, about, unless one text is longer.
GROUP_SETS, GROUP_SHINGLES = 512, 1 << 20
_FLUSH = 1 << 21
_SEEN = 1 << 20
#: Stands for a null doc_id when one text of each set is fetched.
_NO_ID = -(1 << 63)
_U = np.uint64


class _Sets:
    """Distinct shingles of each text of a slice, ordered by text, then by ``order`` of the shingle."""

    def __init__(self, texts: pa.Array, size: int, frequent: np.ndarray | None = None):
        found = words(texts, lower=True)
        codes, counts = found.hashes(), found.counts
        factors = mix(np.arange(1, size + 1, dtype=np.uint64))
        text, at = gram_starts(found.first, size)
        total = np.zeros(len(at), np.uint64)
        for j in range(size):
            total += mix(codes[at + j] + factors[j]) * (factors[j] | _U(1))
        texts_, tokens = [text], [mix(total)]
        for short in range(1, size):  # the whole sequence as one shingle
            own = np.flatnonzero(counts == short)
            total = np.full(len(own), short, np.uint64)
            for j in range(short):
                total += mix(codes[found.first[own] + j] + factors[j]) * (factors[j] | _U(1))
            texts_.append(own)
            tokens.append(mix(total + _U(0x5BD1)))
        text, token = np.concatenate(texts_), np.concatenate(tokens) >> _U(1)
        if frequent is not None and len(frequent):
            spot = np.minimum(np.searchsorted(frequent, token), len(frequent) - 1)
            token = token | ((frequent[spot] == token).astype(np.uint64) << _U(63))
        order = np.lexsort((token, text))
        text, token = text[order], token[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (token[1:] != token[:-1])
        self.text, self.token = text[new], token[new]
        self.sizes = np.bincount(self.text, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])

    def prints(self) -> np.ndarray:
        """Two 64-bit fingerprints of each set, whatever the order; (0, 0) if empty."""
        plain = self.token & _U((1 << 63) - 1)
        out = np.zeros((len(self.sizes), 2), np.uint64)
        full = np.flatnonzero(self.sizes)
        if len(full):
            for k, salt in enumerate((0x1234567, 0x89ABCDEF1)):
                sums = np.add.reduceat(mix(plain + _U(salt)), self.first[full])
                out[full, k] = mix(sums + self.sizes[full].astype(np.uint64))
        return out


class _Seen:
    """Sets this task has already handled, by one fingerprint each; forgetting some only repeats work."""

    def __init__(self):
        self.prints = np.zeros(0, np.uint64)  # sorted

    def new(self, prints: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(sizes), bool)
        full = np.flatnonzero(sizes)
        own, first = np.unique(prints[full, 0], return_index=True)
        at = np.searchsorted(self.prints, own)
        fresh = np.ones(len(own), bool)
        inside = at < len(self.prints)
        fresh[inside] = self.prints[at[inside]] != own[inside]
        out[full[first[fresh]]] = True
        kept_ = len(self.prints) < _SEEN
        self.prints = np.insert(self.prints, at[fresh], own[fresh]) if kept_ else own[fresh]
        return out


def _nodes(prints: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.array([bytes(p) if n else None for p, n in zip(prints, sizes)], pa.binary())


def _halves(prints: np.ndarray) -> pa.Array:
    return pa.array(prints[:, 0].copy().view(np.int64))


_PROFILE = "kind string, doc_id bigint, code bigint, half bigint, node binary, n_shingles bigint, token bigint, times bigint"


def _profile(size: int):
    schema = pa.schema([("kind", pa.string()), ("doc_id", pa.int64()), ("code", pa.int64()), ("half", pa.int64()), ("node", pa.binary()),
                        ("n_shingles", pa.int64()), ("token", pa.int64()), ("times", pa.int64())])

    def repeated(tokens: list[np.ndarray]) -> pa.RecordBatch:
        token, times = np.unique(np.concatenate(tokens), return_counts=True)
        token, times = token[times > 1], times[times > 1]
        none = lambda kind: pa.nulls(len(token), kind)
        return pa.RecordBatch.from_arrays(
            [pa.array(["token"] * len(token), pa.string()), none(pa.int64()), none(pa.int64()), none(pa.int64()), none(pa.binary()),
             none(pa.int64()), pa.array(token.view(np.int64)), pa.array(times)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, n_held = _Seen(), [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                sets = _Sets(part.column("text"), size)
                prints, n = sets.prints(), part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["doc"] * n, pa.string()), part.column("doc_id"), part.column("code"), _halves(prints),
                     _nodes(prints, sets.sizes), pa.array(sets.sizes), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], schema=schema)
                new = sets.token[seen.new(prints, sets.sizes)[sets.text]]
                held.append(new)
                n_held += len(new)
                if n_held >= _FLUSH:
                    yield repeated(held)
                    held, n_held = [], 0
        if n_held:
            yield repeated(held)

    return run


def _prefixes(size: int, percent: int, frequent: np.ndarray, hot: np.ndarray, wanted: bool):
    """``sig, half, n`` rows of the lists that consist of hot shingles, or of all others."""
    both_to = LONG * 100 // percent + 1

    def signatures(token: np.ndarray, n: int) -> np.ndarray:
        prefix = token[: n - (percent * n + 99) // 100 + 2 + n // 10]
        often = prefix >> _U(63) == 1
        very = np.isin(prefix & _U((1 << 63) - 1), hot) if often.any() else often
        alone = np.ones(len(prefix), bool) if n >= LONG else ~often
        sigs, flags = [mix(prefix[alone])], [very[alone]]
        if n < both_to and often.sum() > 1:
            i, j = np.triu_indices(int(often.sum()), 1)
            two, both = prefix[often], very[often]
            sigs.append(mix(mix(two[i] + _U(11)) + two[j]))
            flags.append(both[i] & both[j])
        return np.concatenate(sigs)[np.concatenate(flags) == wanted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            for part in slices(batch, "text"):
                sets = _Sets(part.column("text"), size, frequent)
                prints = sets.prints()
                new = np.flatnonzero(seen.new(prints, sets.sizes))
                found = [signatures(sets.token[sets.first[i] : sets.first[i + 1]], int(sets.sizes[i])) for i in new]
                if found:
                    own = np.repeat(new, [len(sig) for sig in found])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(found).view(np.int64)), _halves(prints[own]),
                         pa.array(sets.sizes[own].astype(np.int32))], names=["sig", "half", "n"])

    return run


def _texts(size: int):
    """``half, chosen, node, text`` of each text with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = _Sets(part.column("text"), size)
                some = np.flatnonzero(sets.sizes)
                prints, rows = sets.prints()[some], part.take(pa.array(some))
                yield pa.RecordBatch.from_arrays(
                    [_halves(prints), pc.fill_null(rows.column("doc_id"), _NO_ID), _nodes(prints, sets.sizes[some]),
                     rows.column("text")], names=["half", "chosen", "node", "text"])

    return run


def _linked(token: np.ndarray, first: np.ndarray, percent: int) -> np.ndarray:
    """For each set the first set of its component, by breadth-first search over exact overlaps."""
    n, sizes = len(first) - 1, np.diff(first)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(token, kind="stable")
    values, owners = token[order], owner[order]
    root, free = np.full(n, -1), n
    for start in range(n):
        if root[start] >= 0:
            continue
        root[start], queue, free = start, [start], free - 1
        while queue and free:
            a = queue.pop()
            own = token[first[a] : first[a + 1]]
            low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            lengths = high - low
            at = np.repeat(low - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            shared = np.bincount(owners[at], minlength=n)
            new = np.flatnonzero((root < 0) & (100 * shared >= percent * (sizes + sizes[a] - shared)))
            root[new] = start
            free -= len(new)
            queue.extend(new.tolist())
    return root


def _verify(size: int, percent: int):
    """Links of each run of equal ``task``; rows arrive sorted by it, so one run is held at a time."""

    def links(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks().to_batches()[0]
        tokens, first = [], [0]
        for part in slices(rows, "text"):
            sets = _Sets(part.column("text"), size)
            tokens.append(sets.token)
            first.extend((sets.first[1:] + first[-1]).tolist())
        root = _linked(np.concatenate(tokens), np.array(first), percent)
        other = np.flatnonzero(root != np.arange(len(root)))
        node = rows.column("node")
        return pa.RecordBatch.from_arrays([node.take(pa.array(other)), node.take(pa.array(root[other]))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, nodes, now = [], set(), None
        for batch in batches:
            for i, (task, node) in enumerate(zip(batch.column("task").to_pylist(), batch.column("node").to_pylist())):
                if task != now:
                    if len(held) > 1:
                        yield links(pa.Table.from_batches(held))
                    held, nodes, now = [], set(), task
                if node not in nodes:  # repeated rows come repeatedly
                    nodes.add(node)
                    held.append(batch.slice(i, 1))
        if len(held) > 1:
            yield links(pa.Table.from_batches(held))

    return run


def _centred(postings: DataFrame, hot: DataFrame | None, percent: int) -> DataFrame:
    """``half, n, centre``: the sets that may have links, with the smallest set of each list they stand in."""
    of_list = W.partitionBy("sig")
    columns = ["half", "n", F.col("least").alias("centre")]
    ends = F.min("half").alias("least"), F.max("half").alias("most")
    found = postings.select("half", "n", *[e.over(of_list).alias(k) for e, k in ((F.min("half"), "least"), (F.max("half"), "most"))])
    found = found.filter("least <> most").select(columns)
    if hot is not None:
        lists = hot.groupBy("sig").agg(*ends).filter("least <> most")
        found = found.union(hot.join(lists, "sig").select(columns))
    lists = kept(found.groupBy("half", "n", "centre").agg(F.count("*").alias("shared")), "candidates")
    able = lists.groupBy("half", "n").agg(F.sum("shared").alias("shared"))
    able = able.filter(f"shared > ({percent} * n div 100) div 10").select("half")  # the smallest partner's t - 1
    return lists.join(able, "half").select("half", "n", "centre")


def _tasks(groups: DataFrame) -> DataFrame:
    """``task, half`` rows: a small group is one task, a large one a task for each two of its blocks."""
    sized = groups.groupBy("centre").agg(F.count("*").alias("sets"), F.sum("n").alias("mass"))
    blocks = F.greatest(F.ceil(F.col("sets") / GROUP_SETS), F.ceil(F.col("mass") / GROUP_SHINGLES)).cast("int")
    dealt = groups.join(sized.select("centre", blocks.alias("blocks")), "centre")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("half"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = [f(F.col("block"), F.col("other")).cast("string") for f in (F.least, F.greatest)]
    return dealt.select(F.concat_ws(":", F.col("centre").cast("string"), *pair).alias("task"), "half")


def _row_code() -> Column:
    """Hash of a row's text and of whether it has an id: with the id, or 0, it stands for rows with the same id and text."""
    return F.xxhash64(F.col("doc_id").cast("bigint").isNull(), F.col("text").cast("string"))


def _sets_and_roots(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Each row's set, the smallest doc_id of each set, and ``node, root`` of the sets with links."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    plain = only_text(docs)
    coded = only_text(docs, None).withColumn("code", _row_code()).withColumn("text", F.coalesce("text", F.lit("")))
    profile = kept(coded.mapInArrow(_profile(size), _PROFILE), "profile")
    sets = profile.filter("kind = 'doc'").select("doc_id", "code", "n_shingles", "half", "node")
    often = profile.filter("kind = 'token'").groupBy("token").agg(F.sum("times").alias("times"))
    often = often.filter(F.col("times") >= FREQUENT_LEAST).orderBy(F.desc("times"), "token").limit(FREQUENT_MAX)
    counted = often.collect()
    frequent, hot = (
        np.sort(np.array([r["token"] for r in counted if r["times"] > least], np.int64).view(np.uint64)) for least in (0, HOT)
    )
    postings = [plain.mapInArrow(_prefixes(size, percent, frequent, hot, wanted), "sig bigint, half bigint, n int")
                for wanted in ([False, True] if len(hot) else [False])]
    tasks = _tasks(_centred(postings[0], postings[1] if len(hot) else None, percent))
    smallest = sets.filter("node is not null").groupBy("node", "half").agg(F.min("doc_id").alias("doc_id"))
    chosen = smallest.select("half", F.coalesce("doc_id", F.lit(_NO_ID)).alias("chosen"))
    texts = plain.mapInArrow(_texts(size), "half bigint, chosen bigint, node binary, text string")
    run = tasks.join(chosen, "half").join(texts, ["half", "chosen"])
    run = run.select("task", "node", "text").repartition("task").sortWithinPartitions("task")
    roots = components(run.mapInArrow(_verify(size, percent), "u binary, v binary"))
    return sets, smallest, roots


def near_copies(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the smallest doc_id reachable by links. Null or empty
    texts and texts without words have no shingles and only themselves. A null
    doc_id is ignored by that minimum; a component without any other has null.
    Repeated rows come back as often as they are given, in one component. An
    empty table gives no rows. A text of any length has all its shingles. Other columns of ``docs`` are ignored. Runs jobs:
    sets, candidates and components are written to the scratch folder.
    """
    sets, smallest, roots = _sets_and_roots(docs, size, percent)
    rooted = smallest.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.select("node", "root").join(named, "root").select("node", "component_id")
    out = sets.join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all its columns: that of the smallest id, then the smallest hash of the text.

    Rows with the same id and text are one document. Rows without an id come after all others,
    so one of them stays where a component has no id. Texts without words are near copies of
    nothing and stay, those without an id each by itself.
    """
    sets, _, roots = _sets_and_roots(docs, size, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("id"), "code")).alias("first")
    firsts = sets.filter("node is not null").groupBy("node").agg(first).join(roots, "node", "left")
    firsts = firsts.groupBy(F.coalesce("root", "node")).agg(F.min("first").alias("first"))
    wordless = sets.filter("node is null").select(F.coalesce("doc_id", F.lit(0)).alias("id"), "code", F.col("doc_id").isNull().alias("each"))
    keep = firsts.select("first.id", "first.code", F.lit(False).alias("each")).union(wordless.distinct())
    named = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"), _row_code().alias("code"),
    )
    rows = named.join(keep, ["id", "code"]).withColumn("apart", F.when(F.col("each"), F.monotonically_increasing_id()))
    return rows.dropDuplicates(["id", "code", "apart"]).select("row.*")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(documents(spark, sf_dir), size=4, percent=85)
