"""HTML extraction by wrapper induction.

Pages of one host and layout are aligned with a reference page of that layout by simple tree matching of their trees
of blocks; blocks that say the same weigh double, so that a constant block among varying siblings meets itself. Slots of
the reference that say the same on nearly all pages are template, slots that vary are content. Two things come out:

- the template: hashes (of path and text) of the constant slots' blocks, wherever they stand;
- the region: the innermost elements on the layout's path that still hold nearly all varying text outside of links,
  and the varying headings. What stands beside it (menus, notices, adverts, footers, however they are named) goes.

A page's text is what its region holds, in page order, without the template. A layout is the path of elements that hold
at least half of a page's text, so parts that come and go do not divide the pages of a host. What mark-up itself sets
apart (by element, role or class) counts less when the region is sought and is left out inside of it; where pages give no
evidence for a region, it alone decides.

Evidence grows smoothly with pages: shares are taken of one page more than there are. Pages that share their longest
block (another than the slot's own) give one vote together, so copies of an article are not its template. Skeletons are
shuffled by host and layout, which adaptive joins split for a frequent host; votes per slot are combined before their
shuffle; a template is shorter than the page it was found on.

Defined cases: a null or empty page has the empty text; pages without a host (null or odd address) have no template;
repeated rows are extracted alike; broken mark-up is read as far as it goes, unclosed elements end with their parent;
elements nested deeper than ``DEEPEST`` are aligned as if they stood at that depth; of pages of any length all text is
read; columns beside ``page_id, url, html`` are not used; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from daybook.llm.common import annotate, durable
from daybook.llm.html import Node, among, leaves, main_leaves, read

#: A slot is template if this share of the votes, and of one more, says the same there.
SAME = 0.75
#: The region holds this share of the varying text, by pages and one more.
MAIN = 0.75
#: Weight of text that mark-up sets apart, when the region is sought.
APART = 0.25
#: Cells of an alignment table held at once; of longer lists of siblings every part of the table is made when it is needed.
CELLS = 1 << 20
#: Parts that the rows of such a table are divided into, and matches remembered by a pair of pages.
PARTS = 16
KNOWN = 1 << 18
#: Nodes of one shape from which on they are weighed together.
FEW = 8
DEEPEST = 200
#: Pages aligned at once, and references remembered by a task.
ROWS = 64
HEADINGS = ("h1", "h2")

#: A skeleton: the layout; depth and label of each node in page order; of leaves the hashes of the text, and of path and
#: text, the weight of the text, and how many elements of the layout's path hold it; whether a leaf is a heading;
#: the two longest blocks.
SKELETON = T.StructType([
    T.StructField("layout", T.StringType()),
    T.StructField("depths", T.ArrayType(T.IntegerType())),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("texts", T.ArrayType(T.LongType())),
    T.StructField("keys", T.ArrayType(T.LongType())),
    T.StructField("weights", T.ArrayType(T.DoubleType())),
    T.StructField("inside", T.ArrayType(T.IntegerType())),
    T.StructField("heads", T.ArrayType(T.BooleanType())),
    T.StructField("longest", T.LongType()),
    T.StructField("second", T.LongType()),
    T.StructField("digest", T.LongType()),
])

#: Of each block: hash of path and text, path, text, where its mark-up sets it apart, whether mark-up makes it main text.
BLOCKS = T.ArrayType(
    T.StructType([
        T.StructField("key", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("aside", T.IntegerType()),
        T.StructField("main", T.BooleanType()),
    ])
)


def host(url: Column) -> Column:
    """Host of an address in lower case, null if it has none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#:@\s]+)", 1)
    return F.when(found != "", found)


def hashed(path: str, text: str) -> int:
    value = xxhash.xxh64_intdigest(f"{path}\n{text}")
    return value - (1 << 64) if value >> 63 else value


def layout(root: Node) -> str:
    """Path of the elements, from the outermost, that hold at least half of the page's text outside of links."""
    order, stack = [], [root]
    while stack:
        order.append(stack.pop())
        stack.extend(order[-1].children)
    held: dict[int, int] = {}
    for node in reversed(order):
        own = 0 if node.text is None else len(node.text) - node.linked
        held[id(node)] = own + sum(held[id(child)] for child in node.children)
    path, node = f"/{root.label}", root
    while node:
        half = (c for c in node.children if any(x.text is None for x in c.children) and held[id(c)] * 2 >= held[id(root)] > 0)
        node = next(half, None)
        path += f"/{node.label}" if node else ""
    return path


def skeleton(page: str | None) -> tuple:
    """The tree of a page's blocks, every block a node of its own, as the fields of ``SKELETON``."""
    root = read(page or "")
    way = layout(root)
    steps = way.split("/")[1:]
    depths, labels, texts, keys, weights, inside, heads = [], [], [], [], [], [], []
    longest: list[tuple[int, int]] = []
    places: dict[str, tuple[int, bool]] = {}
    stack = [(child, f"/{root.label}") for child in reversed(root.children)]
    while stack:
        node, above = stack.pop()
        depths.append(min(node.depth - 1, DEEPEST))
        labels.append(node.label)
        if node.text is None:
            path = f"{above}/{node.label}"
            texts.append(0), keys.append(0), weights.append(0.0), inside.append(0), heads.append(False)
            stack.extend((child, path) for child in reversed(node.children))
            continue
        if above not in places:
            parts = above.split("/")[1:]
            shared = next((i for i, (a, b) in enumerate(zip(parts, steps, strict=False)) if a != b), min(len(parts), len(steps)))
            places[above] = shared, parts[-1].split(".")[0] in HEADINGS
        shared, head = places[above]
        texts.append(hashed("", node.text))
        keys.append(hashed(above, node.text))
        weights.append((len(node.text) - node.linked) * (APART if node.aside else 1.0))
        inside.append(shared)
        heads.append(head and not node.aside)
        if len(longest) < 2 or len(node.text) >= longest[1][0]:
            longest = sorted([*longest, (len(node.text), texts[-1])], reverse=True)[:2]
    first, second = ([key for _, key in longest] + [0, 0])[:2]
    return way, depths, labels, texts, keys, weights, inside, heads, first, second, hashed("/".join(labels), ",".join(map(str, keys)))


def arrays(make, kinds: list[pa.DataType]):
    """A function from a list of texts to one Arrow array for each field, for ``annotate``."""

    def run(texts: list) -> list[pa.Array]:
        columns = list(zip(*map(make, texts), strict=True)) if texts else [[] for _ in kinds]
        return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]

    return lambda: run


def skeletons(pages: DataFrame) -> DataFrame:
    """``host`` and the skeleton of each different page of the hosts that are known."""
    known = pages.select(host(F.col("url")).alias("host"), "html").where("host is not null")
    kinds = [pa.string(), *map(pa.list_, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.bool_()))]
    make = arrays(skeleton, [*kinds, pa.int64(), pa.int64(), pa.int64()])
    read_pages = annotate(known, ["host"], "html", SKELETON, make).select("row.host", *SKELETON.names)
    return read_pages.dropDuplicates(["host", "digest"])


def children_of(depths: list[int]) -> list[list[int]]:
    """Children of each node, the last list for the roots."""
    children: list[list[int]] = [[] for _ in range(len(depths) + 1)]
    above: list[int] = []
    for i, depth in enumerate(depths):
        del above[depth:]
        children[above[-1] if above else -1].append(i)
        above.append(i)
    return children


class Matcher:
    """Simple tree matching: the weightiest order-preserving match of two trees in which parents match with parents.

    A pair of nodes weighs 1, a pair of blocks with the same text 2.
    """

    def __init__(self, page: tuple[list[int], list[str], list[int]], reference: tuple[list[int], list[str], list[int]]) -> None:
        self.labels = page[1], reference[1]
        self.texts = page[2], reference[2]
        self.children = children_of(page[0]), children_of(reference[0])
        self.memo: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
        self.numbers: tuple[list[int], list[int]] | None = None
        self.shapes: list[int] | None = None

    def match(self, a: int = -1, b: int = -1) -> list[tuple[int, int]]:
        """Pairs of matched nodes of the page and the reference, below two matched nodes."""
        pairs, queue = [], [(a, b)]
        while queue:
            for pair in self.weigh(*queue.pop())[1]:
                pairs.append(pair)
                queue.append(pair)
        return pairs

    def weigh(self, a: int, b: int) -> tuple[int, list[tuple[int, int]]]:
        """Weight of the best match below two nodes, and the pairs of their children in it."""
        known = self.memo.get((a, b))
        if known:
            return known
        left, right = self.children[0][a], self.children[1][b]
        found = (self.long if len(left) * len(right) > CELLS else self.table)(left, right)
        if len(self.memo) >= KNOWN:
            self.memo.clear()
        self.memo[a, b] = found
        return found

    def pair(self, a: int, b: int) -> int:
        """Weight of two nodes with equal labels and of the best match below them."""
        left, right = self.children[0][a], self.children[1][b]
        if not left or not right:
            return 2 if self.texts[0][a] and self.texts[0][a] == self.texts[1][b] else 1
        if len(left) == len(right) == 1 and self.labels[0][left[0]] == self.labels[1][right[0]] == "#":
            return 3 if self.texts[0][left[0]] == self.texts[1][right[0]] != 0 else 2
        return 1 + self.weigh(a, b)[0]

    def table(self, left: list[int], right: list[int]) -> tuple[int, list[tuple[int, int]]]:
        labels, pair = [self.labels[1][b] for b in right], self.pair
        size = [[0] * (len(right) + 1)]
        for a in left:
            above, label, row, best = size[-1], self.labels[0][a], [0], 0
            for j, b in enumerate(right):
                if above[j + 1] > best:
                    best = above[j + 1]
                if labels[j] == label:
                    both = above[j] + pair(a, b)
                    if both > best:
                        best = both
                row.append(best)
            size.append(row)
        pairs, i, j = [], len(left), len(right)
        while i and j:
            if size[i][j] == size[i - 1][j]:
                i -= 1
            elif size[i][j] == size[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((left[i], right[j]))
        return size[-1][-1], pairs[::-1]

    def kinds(self) -> tuple[list[int], list[int]]:
        """A number for each node; nodes of the same number weigh the same with any node of the other tree."""
        if self.numbers is None:
            shared = set(self.texts[0]) & set(self.texts[1])
            said = [[text if text in shared else 0 for text in texts] for texts in self.texts]
            known: dict[tuple, int] = {}
            self.numbers = self.numbered(0, said[0], known), self.numbered(1, said[1], known)
        return self.numbers

    def numbered(self, side: int, texts: list[int], known: dict[tuple, int]) -> list[int]:
        """A number for each node of a tree, the same for equal subtrees when blocks say ``texts``."""
        numbers = [0] * len(texts)
        for i in range(len(texts) - 1, -1, -1):  # children stand after their parent
            below = tuple(numbers[child] for child in self.children[side][i])
            numbers[i] = known.setdefault((self.labels[side][i], texts[i], below), len(known))
        return numbers

    def with_all(self, a: int, b: int, texts: list[np.ndarray], first: int) -> np.ndarray | int:
        """What ``pair`` finds for a node and all nodes of one shape: ``texts`` is what they say, by distance from ``first``."""
        left, right = self.children[0][a], self.children[1][b]

        def same(x: int, y: int) -> np.ndarray | bool:
            return self.texts[0][x] != 0 and texts[y - first] == self.texts[0][x]

        if not left or not right:
            return 1 + same(a, b)
        if len(left) == len(right) == 1 and self.labels[0][left[0]] == self.labels[1][right[0]] == "#":
            return 2 + same(left[0], right[0])
        above = [0] * (len(right) + 1)
        for x in left:
            row = [0]
            for j, y in enumerate(right):
                best = np.maximum(above[j + 1], row[-1])
                if self.labels[0][x] == self.labels[1][y]:
                    best = np.maximum(best, above[j] + self.with_all(x, y, texts, first))
                row.append(best)
            above = row
        return 1 + above[-1]

    def long(self, left: list[int], right: list[int]) -> tuple[int, list[tuple[int, int]]]:
        """What ``table`` finds, for lists of any length in memory that grows with their sum.

        The table's rows are made one after the other, and the first row of each of its parts is kept. From these the
        parts are made again, the last one first, as the way back leads through them. A common beginning needs no table:
        nodes of one kind weigh most with each other, so the way back ends there.
        """
        kinds, pairs, weight = self.kinds(), [], 0
        for a, b in zip(left, right, strict=False):
            if kinds[0][a] != kinds[1][b]:
                break
            pairs.append((a, b))
            weight += self.pair(a, b)
        left, right = left[len(pairs) :], right[len(pairs) :]
        if len(left) * len(right) <= CELLS:
            more, rest = self.table(left, right)
            return weight + more, pairs + rest
        some = {kinds[1][b]: b for b in right}  # one node of each kind
        place = {kind: i for i, kind in enumerate(some)}
        at, nodes = np.array([place[kinds[1][b]] for b in right]), list(some.values())
        if self.shapes is None:
            self.shapes = self.numbered(1, [0] * len(self.texts[1]), {})
        alike: dict[int, list[int]] = {}
        for i, b in enumerate(nodes):
            alike.setdefault(self.shapes[b], []).append(i)
        groups: dict[str, list[tuple[int, list[int], list[np.ndarray]]]] = {}
        for members in alike.values():
            first, texts = nodes[members[0]], []
            if len(members) >= FEW:
                end = first + 1
                while self.children[1][end - 1]:
                    end = self.children[1][end - 1][-1] + 1
                texts = [np.array([self.texts[1][nodes[i] + k] for i in members], np.int64) for k in range(end - first)]
            groups.setdefault(self.labels[1][first], []).append((first, members, texts))
        cache: dict[int, np.ndarray] = {}

        def weights(a: int) -> np.ndarray:
            """Weights of a node of ``left`` with each of ``right``, 0 where labels differ."""
            if kinds[0][a] not in cache:
                if (len(cache) + 1) * len(nodes) > PARTS * CELLS:
                    cache.clear()
                by_kind = np.zeros(len(nodes), np.int32)
                for first, members, texts in groups.get(self.labels[0][a], ()):
                    if texts:
                        by_kind[members] = self.with_all(a, first, texts, first)
                    else:
                        for i in members:
                            by_kind[i] = self.pair(a, nodes[i])
                cache[kinds[0][a]] = by_kind
            return cache[kinds[0][a]][at]

        total, back, column = None, [], len(right)
        parts = [(0, len(left), np.zeros(column + 1, np.int64))]
        while parts and column:
            first, last, row = parts.pop()
            row = row[: column + 1]
            step = 1 if (last - first) * (column + 1) <= CELLS else -(-(last - first) // PARTS)
            kept = []
            for i in range(first, last):
                if (i - first) % step == 0:
                    kept.append(row)
                best = row.copy()
                np.maximum(row[1:], row[:-1] + weights(left[i])[:column], out=best[1:])
                row = np.maximum.accumulate(best)
            total = int(row[-1]) if total is None else total
            if step > 1:
                parts += [(i, min(i + step, last), kept[k]) for k, i in enumerate(range(first, last, step))]
                continue
            size, i = [*kept, row], last
            while i > first and column:
                if size[i - first][column] == size[i - first - 1][column]:
                    i -= 1
                elif size[i - first][column] == size[i - first][column - 1]:
                    column -= 1
                else:
                    i, column = i - 1, column - 1
                    back.append((left[i], right[column]))
        return weight + total, pairs + back[::-1]


COUNTED = "host string, layout string, slot int, key long, weight double, inside int, head boolean, vote long"


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.int32(), pa.bool_(), pa.int64()]
    names = [part.split()[0] for part in COUNTED.split(", ")]
    trees: dict[tuple[str, str], tuple] = {}
    for batch in batches:
        given = [c for c in batch.schema.names if not c.startswith("r_")]
        for at in range(0, batch.num_rows, ROWS):
            out = []
            for i, row in enumerate(batch.select(given).slice(at, ROWS).to_pylist(), at):
                place = row["host"], row["layout"]
                if place not in trees:
                    if len(trees) >= ROWS:
                        trees.clear()
                    trees[place] = tuple(batch.column(f"r_{c}")[i].as_py() for c in ("depths", "labels", "texts"))
                slots = dict(Matcher((row["depths"], row["labels"], row["texts"]), trees[place]).match())
                longest, second = row["longest"], row["second"]
                facts = zip(row["labels"], row["texts"], row["keys"], row["weights"], row["inside"], row["heads"], strict=True)
                out += [
                    (*place, slots.get(k, -1), key, weight, inside, head, second if text == longest else longest)
                    for k, (label, text, key, weight, inside, head) in enumerate(facts)
                    if label == "#"
                ]
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def templates(pages: DataFrame) -> DataFrame:
    """``t_host, t_layout, template, region``: what was found for each layout of each host."""
    read_pages = durable(skeletons(pages), "skeletons")
    smallest = F.struct(F.xxhash64("digest").alias("place"), F.struct("depths", "labels", "texts").alias("tree"))
    reference = read_pages.groupBy("host", "layout").agg(F.min(smallest).alias("smallest"), F.count("*").alias("pages"))
    trees = [F.col(f"smallest.tree.{c}").alias(f"r_{c}") for c in ("depths", "labels", "texts")]
    # Written first, so that both sides of the join are plain exchanges, which are split for a frequent host. No decision
    # is ever taken on a single page, as its share is of one more.
    reference = durable(reference.where("pages > 1").select("host", "layout", *trees), "references")
    columns = ["host", "layout", "depths", "labels", "texts", "keys", "weights", "inside", "heads", "longest", "second"]
    both = read_pages.select(*columns).join(reference, ["host", "layout"])
    place, said = ["host", "layout", "slot", "inside", "head"], ["host", "layout", "slot", "inside", "head", "key"]
    votes = both.mapInArrow(_aligned, COUNTED).groupBy(*said, "vote").agg(F.sum("weight").alias("weight"))
    counted = votes.groupBy(*said).agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))
    slots = counted.groupBy(*place).agg(
        F.max(F.struct("n", "key")).alias("most"), F.sum("n").alias("votes"), F.sum("weight").alias("weight")
    )
    constant = (F.col("slot") >= 0) & (F.col("most.n") >= SAME * (F.col("votes") + 1))
    slots = durable(slots.withColumn("constant", constant), "slots")
    found = slots.where("constant").groupBy("host", "layout").agg(F.collect_set("most.key").alias("template"))
    sizes = read_pages.groupBy("host", "layout", "longest").agg(F.lit(1).alias("one")).groupBy("host", "layout").agg(F.count("*").alias("n"))
    whole = W.partitionBy("host", "layout")
    depth = (
        slots.where("not constant")
        .groupBy("host", "layout", "inside")  # one row for each element of the layout's path
        .agg(F.sum("weight").alias("weight"), F.max("head").alias("head"))
        .withColumn("held", F.sum("weight").over(whole.orderBy(F.desc("inside")).rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("total", F.sum("weight").over(whole))
        .join(sizes, ["host", "layout"])
        .groupBy("host", "layout")
        .agg(
            F.max(F.when(F.col("held") * F.col("n") >= MAIN * F.col("total") * (F.col("n") + 1), F.col("inside"))).alias("held"),
            F.min(F.when(F.col("head"), F.col("inside"))).alias("heading"),
        )
    )
    steps = F.split("layout", "/")
    deep = F.when(F.col("held").isNotNull(), F.least("held", "heading"))
    path = F.array_join(F.slice(steps, 1, deep + 1), "/")
    inner = F.element_at(steps, deep + 1)
    regions = depth.select("host", "layout", F.when((deep > 0) & ~inner.isin("page", "html", "body"), path).alias("region"))
    return (
        found.join(regions, ["host", "layout"], "full")
        .where("template is not null or region is not null")
        .select(F.col("host").alias("t_host"), F.col("layout").alias("t_layout"), "template", "region")
    )


def blocks(page: str | None) -> tuple[str, list[tuple]]:
    """Layout of a page, and its blocks in page order."""
    root = read(page or "")
    found = list(leaves(root))
    main = {id(leaf) for leaf, _ in among(found)}
    return layout(root), [(hashed(path, leaf.text), path, leaf.text, leaf.aside, id(leaf) in main) for leaf, path in found]


def chosen(template: Column, region: Column) -> Column:
    """Text of the column ``blocks`` under a region, without a template; where there is no region, of what is marked as main."""
    depth = F.size(F.split(region, "/")) - 2  # the page itself stands at 0

    def stays(block: Column) -> Column:
        under = F.startswith(F.concat(block["path"], F.lit("/")), F.concat(region, F.lit("/"))) & (block["aside"] <= depth)
        return F.when(region.isNull(), block["main"]).otherwise(under) & ~F.array_contains(template, block["key"])

    return F.array_join(F.transform(F.filter("blocks", stays), lambda block: block["text"]), " ")


def main_text(page: str | None) -> str:
    """Text of a page's main part by its mark-up alone, blocks joined by a space."""
    return " ".join(leaf.text for leaf, _ in main_leaves(read(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """One row for each page: ``page_id, url, text``, and ``decided``, whether its host's other pages had a say."""
    known = durable(templates(pages), "templates")
    with_host = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    fields = T.StructType([T.StructField("layout", T.StringType()), T.StructField("blocks", BLOCKS)])
    make = arrays(blocks, [pa.string(), to_arrow_type(BLOCKS)])
    split = annotate(with_host, ["page_id", "url", "host"], "html", fields, make)
    joined = split.join(known, (F.col("row.host") == F.col("t_host")) & (F.col("layout") == F.col("t_layout")), "left")
    template = F.coalesce("template", F.array().cast("array<bigint>"))
    decided = F.col("t_host").isNotNull()
    return joined.select("row.page_id", "row.url", chosen(template, F.col("region")).alias("text"), decided.alias("decided"))
