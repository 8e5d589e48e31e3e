"""Main text of web pages by deducing the template of each host.

A page is a sequence of tokens: its containers by their path (each opening tag with the containers around it) and its text
blocks, each with its container. A token's occurrence vector says how often it occurs in each page of the host; tokens with
equal vectors form an equivalence class. Classes that enough pages share, some of them different pages, are the host's template.

The root class is what each page has once. It is valid only in order: a token that does not come in the order of the others on
some page is taken out. A token that a page has several times plays several roles, one in each gap of the root class, so that its
occurrences are nested in gaps and have vectors of their own; roles that each page has once join the root class, which makes
more gaps, until no host's root class changes. Classes whose tokens occur once are ordered by their mean places, and a page takes the
longest sequence of them that comes in this order; of roles that recur in a gap it takes all occurrences there.

What the template leaves open between its tokens are slots, and every page is extracted from its slots, but for containers that are no
part of an article. Article elements, else main elements, with an open slot are the article, template text inside them included; those that
the template fills are none. Where no such element has a slot the main container is the lowest one that holds nearly all open
text and the first heading; all its text belongs to the article and each slot that it holds a part of, but where it is the page's body:
there the template's text goes and the open slots stay. A page alone on its host has no template, and all its text is open.

Vectors are never gathered: each is a sum of hashes of (page, count), so that classes are found by grouping equal sums. Pages are
read twice; the rounds between work on the sequences of tokens alone.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, discard, durable

#: A class belongs to the template if so many pages, and this share of a host's pages, have its tokens.
SUPPORT, SHARE = 3, 0.5
#: The share of a page's open text that its main container holds where no element marks the article.
NEARLY_ALL = 0.75

_RAW = "script|style|noscript|template|textarea|select|svg|iframe|object|title|math|canvas|audio|video"
_TAG = re.compile(rf"(?is)<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<({_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:(?<=/)>|>.*?(?:</\1\s*>|\Z))|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-z][^\s/>]*)([^>]*)(?:>|\Z)")  # the last for tags with a quote that never ends
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
_CONTAINERS = frozenset("html head body div section article main nav header footer aside form ul ol dl table fieldset dialog menu figure center details".split())
_PAGE = frozenset(("html", "body"))
_NEVER = frozenset("head nav footer aside form dialog menu fieldset".split())
#: A class, id or role marks a container as no part of an article if all its words are of these or of the next, and one of these.
_NEVER_NAMED = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus dialog footer gdpr "
    "login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promotion recommended related replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
_PLAIN = frozenset("area bar block bottom box container content global inner item items left link links list main outer page panel post posts reader region right section site top user wrap wrapper zone".split())
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    """A container: its parent, the hash of its path, its tag with class, what it is, and its place among the page's tokens."""

    __slots__ = ("parent", "hash", "name", "tag", "never", "named", "main", "banned", "depth", "place", "token")

    def __init__(self, parent: Node | None, name: str, tag: str, never: bool, named: bool, place: int = -1):
        self.parent, self.name, self.tag, self.never, self.named, self.banned, self.place = parent, name, tag, never, named, False, place
        self.hash = xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass"), parent.hash if parent else 0)
        self.token = _signed(self.hash & ~1)
        self.main = "article" if tag == "article" or parent and parent.main == "article" else "main" if tag == "main" or parent and parent.main else ""
        self.depth = parent.depth + 1 if parent else 0


class Block:
    __slots__ = ("node", "text", "level", "place", "token")

    def __init__(self, node: Node, text: str, level: int, place: int):
        self.node, self.text, self.level, self.place = node, text, level, place
        self.token = _signed(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), node.hash) | 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def never_named(value: str) -> bool:
    """Whether one of the names in a class, id or role says that it is no part of an article: 'cookie-notice' does, 'share-price' does not."""
    for name in value.split():
        words = [w for w in _SPLIT.split(_CAMEL.sub(" ", name).lower()) if w and not w.isdigit()]
        if not _NEVER_NAMED.isdisjoint(words) and all(w in _NEVER_NAMED or w in _PLAIN for w in words):
            return True
    return False


def _named(attributes: str) -> tuple[str, bool, bool]:
    """The class of a tag, whether it is hidden, and whether its class, id or role says that it is no part of an article."""
    kind, hidden, named = "", False, False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value, name = a or b or c, name.lower()
        if name == "class":
            kind = ".".join(value.lower().split())
        if name == "hidden":
            hidden = True
        elif name in ("class", "id", "role"):
            named = named or never_named(value)
    return kind, hidden, named


def parse(page: str) -> tuple[list[Node], list[Block]]:
    """All containers and all text blocks in page order; work and memory are in proportion to the page."""
    root = Node(None, "", "", False, False)
    opened: list[Node] = []
    blocks: list[Block] = []
    names: Counter = Counter()
    node, level, place = root, 0, 0
    parts: list[str] = []

    def close() -> None:
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        if text:
            blocks.append(Block(node, text, level, len(opened) + len(blocks)))

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        tag = m[3] or m[6]
        if not tag:
            continue
        tag, ends, attributes = tag.lower(), m[2] or m[5], m[4] or m[7] or ""
        if tag in _INLINE:
            if tag in ("br", "img", "wbr"):
                parts.append(" ")
            continue
        close()
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            level = 0 if ends else int(tag[1])
        if tag not in _CONTAINERS:
            continue
        level = 0
        if ends:
            if names[tag]:
                while node.tag != tag:
                    names[node.tag] -= 1
                    node = node.parent
                names[tag] -= 1
                node = node.parent
        elif not attributes.endswith("/"):
            kind, hidden, named = _named(attributes) if attributes else ("", False, False)
            never = hidden or tag in _NEVER or tag == "header" and not node.main
            whole = tag in _PAGE  # one a page, whatever its class, which often names the page
            node = Node(node, f"{tag}.{kind}" if kind and not whole else tag, tag, never, named and not whole and tag != "main", len(opened) + len(blocks))
            names[tag] += 1
            opened.append(node)
    if at < len(page):
        parts.append(page[at:])
    close()
    _ban(opened)
    return opened, blocks


def _ban(opened: list[Node]) -> None:
    """Mark what is no part of an article. Names alone do not do so for containers around the page's only articles."""
    mains = [x for x in opened if x.tag in ("article", "main")]
    for spared in (False, True):
        holds = set()
        if spared:
            x = mains[0]
            while x is not None and id(x) not in holds:
                holds.add(id(x))
                x = x.parent
        for x in opened:
            x.banned = x.never or x.parent.banned or x.named and id(x) not in holds
        if not mains or any(not x.banned for x in mains):
            break


def _rising(places: list[int]) -> set[int]:
    """The indices of a longest rising sequence."""
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for i, p in enumerate(places):
        k = bisect_left(tails, p)
        before.append(ends[k - 1] if k else -1)
        tails[k : k + 1], ends[k : k + 1] = [p], [i]
    out, i = set(), ends[-1] if ends else -1
    while i >= 0:
        out.add(i)
        i = before[i]
    return out


def sequence(opened: list[Node], blocks: list[Block]) -> list[int]:
    """The tokens of a page in their order; a container's are even, a text's are odd."""
    out = [0] * (len(opened) + len(blocks))
    for x in opened:
        out[x.place] = x.token
    for b in blocks:
        out[b.place] = b.token
    return out


def along(tokens: list[int], root: list[int]) -> dict[int, int]:
    """Which tokens of the root class a page has at which places: all, if they come in order. Else the longest sequence in order of
    those that both have once, and so on between any two of them; where there are none, those up to the first that is missing."""
    out, k = {}, 0
    for i, t in enumerate(tokens):
        if k < len(root) and t == root[k]:
            out[i], k = k, k + 1
    if k == len(root):
        return out
    out, todo = {}, [(0, len(tokens), 0, len(root))]
    while todo:
        i0, i1, k0, k1 = todo.pop()
        here, there = Counter(tokens[i0:i1]), Counter(root[k0:k1])
        once = {root[k]: k for k in range(k0, k1) if there[root[k]] == here[root[k]] == 1}
        pairs = [(i, once[tokens[i]]) for i in range(i0, i1) if tokens[i] in once]
        if pairs:
            pairs = [pairs[j] for j in sorted(_rising([k for _, k in pairs]))]
            out.update(pairs)
            ends = [(i0 - 1, k0 - 1), *pairs, (i1, k1)]
            todo += [(a + 1, b, x + 1, y) for (a, x), (b, y) in zip(ends, ends[1:]) if b - a > 1 and y - x > 1]
            continue
        for i in range(i0, i1):
            if k0 < k1 and tokens[i] == root[k0]:
                out[i], k0 = k0, k0 + 1
    return out


def _gaps(n: int, matched: dict[int, int]) -> list[int]:
    """Per place of a page the gap of the root class that it lies in."""
    out, gap = [], 0
    for i in range(n):
        gap = matched[i] + 1 if i in matched else gap
        out.append(gap)
    return out


#: Kinds of a template's tokens: of a root class that tells roles apart; once on a page, wherever that is. Others are roles in a gap.
IN_ROOT, ANYWHERE = -2, -1


class Template:
    """The tokens of a host's template in their order, each with its kind: IN_ROOT, ANYWHERE, or its gap doubled, and 1 more if it recurs there."""

    def __init__(self, tokens: list[int], kinds: list[int]):
        self.root, self.root_rank, self.once, self.roles, self.recur = [], [], {}, {}, set()
        for rank, (t, kind) in enumerate(zip(tokens, kinds)):
            if kind == IN_ROOT:
                self.root.append(t)
                self.root_rank.append(rank)
            elif kind == ANYWHERE:
                self.once[t] = rank
            elif kind & 1:
                self.recur.add((t, kind >> 1))
            else:
                self.roles[t, kind >> 1] = rank

    def fixed(self, tokens: list[int]) -> set[int]:
        """The places of a page's template tokens."""
        matched = along(tokens, self.root) if self.root else {}
        gaps = _gaps(len(tokens), matched) if self.roles or self.recur else None
        at, ranks, out = [], [], set()
        for i, t in enumerate(tokens):
            rank = self.root_rank[matched[i]] if i in matched else self.once.get(t)
            if rank is None and gaps:
                if (t, gaps[i]) in self.recur:
                    out.add(i)
                rank = self.roles.get((t, gaps[i]))
            if rank is not None:
                at.append(i)
                ranks.append(rank)
        return out | {at[k] for k in _rising(ranks)}


def open_slots(opened: list[Node], blocks: list[Block], template: Template | None) -> tuple[set[int], list[Block]]:
    """The places of template tokens, and the blocks that are no template text. A page of which the template would take
    nearly all text is a copy of others, not their template, and stays whole."""
    fixed = template.fixed(sequence(opened, blocks)) if template else set()
    kept = [b for b in blocks if b.place not in fixed]
    size = sum(len(b.text) for b in blocks if not b.node.banned)
    if sum(len(b.text) for b in kept if not b.node.banned) < (1 - NEARLY_ALL) * size:
        return set(), blocks
    return fixed, kept


def _above(a: Node, b: Node) -> Node:
    """The lowest container of both."""
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return a


def _main_container(opened: list[Node], slots: list[Block]) -> Node:
    """The lowest container with nearly all open text and the first heading."""
    size: Counter = Counter()
    for b in slots:
        size[id(b.node)] += len(b.text)
    total = size.total()
    for x in reversed(opened):  # children come after their parents
        size[id(x.parent)] += size[id(x)]
    best = max((x for x in opened if size[id(x)] >= NEARLY_ALL * total), key=lambda x: x.depth, default=None)
    if best is None:
        best = slots[0].node
        while best.parent is not None:
            best = best.parent
    heading = next((b.node for b in slots if b.level == 1), best)
    return _above(best, heading)


def _marked(opened: list[Node], free: list[Block], slots: list[Block]) -> list[Block]:
    """The text of the outermost article elements that have an open slot, else of such main elements."""
    for tag in ("article", "main"):
        top: dict[int, int] = {}
        for x in opened:
            found = top.get(id(x.parent)) or (id(x) if x.tag == tag else None)
            if found:
                top[id(x)] = found
        has_slot = {top[id(b.node)] for b in slots if id(b.node) in top}
        if has_slot:
            return [b for b in free if top.get(id(b.node)) in has_slot]
    return []


def _whole_slots(opened: list[Node], inner: list[Block], free: list[Block], slots: list[Block], fixed: set[int]) -> list[Block]:
    """inner and all blocks of the slots that it has a part of. A slot lies between two template tokens, in one template container;
    where the template is no more than the frame that any page has, it bounds none."""
    places = sorted(fixed.difference(x.place for x in opened if x.tag in _PAGE or x.tag == "head"))
    if not places:
        return inner

    def slot(b: Block) -> tuple[int, int]:
        x = b.node
        while x.parent is not None and x.place not in fixed:
            x = x.parent
        return id(x), bisect_left(places, b.place)

    of = {b.place: slot(b) for b in slots}
    mine = {b.place for b in inner}
    touched = {of[p] for p in mine if p in of}
    return [b for b in free if b.place in mine or of.get(b.place) in touched]


def extract(page: str, template: Template | None = None) -> tuple[str, str | None]:
    """The main text of a page, and the path of the lowest container of all of it."""
    opened, blocks = parse(page)
    free = [b for b in blocks if not b.node.banned]
    if not free:
        return "", None
    fixed, kept = open_slots(opened, blocks, template)
    slots = [b for b in kept if not b.node.banned] or free
    inner = _marked(opened, free, slots)
    if not inner:
        best = _main_container(opened, slots)
        within = {id(best)}
        for x in opened:
            if id(x.parent) in within:
                within.add(id(x))
        if not best.tag or best.tag in _PAGE:
            inner = slots
        else:
            inner = [b for b in free if id(b.node) in within]
            inner = _whole_slots(opened, inner, free, slots, fixed)
    low = inner[0].node
    for b in inner[1:]:
        low = _above(low, b.node)
    path = []
    while low.parent is not None:
        path.append(low.name)
        low = low.parent
    return "\n\n".join(b.text for b in inner), ">".join(reversed(path))


def host_of(url) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#:]*)", 1), F.lit("")))


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: its host, its id, the hash of its texts, its tokens."""
    for whole in batches:
        for lo in range(0, len(whole), 256):
            batch = whole.slice(lo, 256)
            looks, tokens = [], []
            for text in batch.column(2).to_pylist():
                opened, blocks = parse(text or "")
                looks.append(_signed(xxhash.xxh64_intdigest("\n".join(b.text for b in blocks).encode("utf-8", "surrogatepass"))))
                tokens.append(sequence(opened, blocks))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), pa.array(looks, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))], ["host", "page", "look", "tokens"])


_COUNTS = "host string, token long, gap int, vector long, pages long, place double, most_often long, least long, most long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, host, token and gap: its vector, a sum of hashes of (page, count); pages; the sum of its mean places in them; how often
    a page has it at most; the least and the largest hash of a page's texts. Without a root class all tokens are counted, at gap -1, and
    token 0 is the page itself; with one the roles of the tokens that recur, and at gap -2 tokens of the root class out of order."""
    for whole in batches:
        for lo in range(0, len(whole), 256):
            batch = whole.slice(lo, 256)
            found: dict[tuple[str, int, int], list] = {}
            for host, page, look, tokens, root, recur in zip(*(batch.column(i).to_pylist() for i in range(6))):
                places: dict[tuple[int, int], list[int]] = {}
                if root is None:
                    places[0, -1] = [0]
                    for i, t in enumerate(tokens):
                        places.setdefault((t, -1), []).append(i)
                else:
                    matched, recur = along(tokens, root), set(recur)
                    for k in set(range(len(root))).difference(matched.values()):
                        places.setdefault((root[k], -2), []).append(0)
                    for i, (t, gap) in enumerate(zip(tokens, _gaps(len(tokens), matched))):
                        if t in recur and i not in matched:
                            places.setdefault((t, gap), []).append(i)
                for (token, gap), at in places.items():
                    got = found.setdefault((host, token, gap), [0, 0, 0.0, 0, look, look])
                    got[0] += xxhash.xxh64_intdigest(f"{page}\x00{len(at)}") >> 32
                    got[1] += 1
                    got[2] += sum(at) / len(at) / (1 + len(tokens))
                    got[3], got[4], got[5] = max(got[3], len(at)), min(got[4], look), max(got[5], look)
            keys, values = list(found), list(found.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32()))]
                + [pa.array([v[i] for v in values], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()))],
                [c.split()[0] for c in _COUNTS.split(", ")],
            )


def _counted(pages: DataFrame, support: int) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("vector", "pages", "place")]
    ends = [F.max("most_often").alias("most_often"), F.min("least").alias("least"), F.max("most").alias("most")]
    counted = pages.select("host", "page", "look", "tokens", "root", "recur").mapInArrow(_count, _COUNTS).groupBy("host", "token", "gap").agg(*sums, *ends)
    return durable(counted.filter((F.col("pages") >= support) | (F.col("gap") == -2)))


def _roles(pages: DataFrame, state: DataFrame, support: int) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """The hosts with their final root classes, the counts of the roles that these tell apart, and what to discard in the end.

    Each round takes tokens out of order from the root class, for good, or adds roles that each page has once; so rounds end."""
    settled, roles, staged = [], [], []
    while True:
        state = durable(state)
        staged.append(state)
        n, size = state.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("host") + 16 * F.size("spine") + 8 * F.size("recur")), F.lit(0))).first()
        if not n:
            return settled, roles, staged
        roots = state.select("host", F.transform("spine", lambda x: x["token"]).alias("root"), "recur")
        counted = _counted(pages.join(broadcast_if_small(roots, 1, size + 64 * n), "host"), support)
        staged.append(counted)
        is_new = (F.col("gap") >= 0) & (F.col("most_often") == 1) & (F.col("pages") == F.col("all_pages")) & (F.col("vector") == F.col("whole"))
        changes = counted.join(state.select("host", "all_pages", "whole", "barred"), "host").groupBy("host").agg(
            F.collect_set(F.when(F.col("gap") == -2, F.col("token"))).alias("out"),
            F.collect_list(F.when(is_new & ~F.expr("array_contains(barred, token)"), F.struct((F.col("place") / F.col("pages")).alias("place"), "token"))).alias("new"),
        )
        after = durable(state.join(changes, "host", "left").withColumns({"out": F.expr("coalesce(out, array())"), "changed": F.expr("coalesce(size(out) + size(new), 0) > 0")}))
        staged.append(after)
        settled.append(after.filter("not changed").select("host", "spine"))
        roles.append(counted.join(settled[-1].select("host"), "host", "left_semi"))
        spine = F.expr("if(size(out) > 0, filter(spine, x -> not array_contains(out, x.token)), array_sort(concat(spine, new)))")
        state = after.filter("changed").select("host", "all_pages", "whole", spine.alias("spine"), "recur", F.concat("barred", "out").alias("barred"))


def templates(pages: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """host, template and kinds: the tokens of its classes in their order, and what Template is to know of them; pages has page, host, html."""
    pages = durable(pages.mapInArrow(_sequences, "host string, page long, look long, tokens array<long>"))
    none = F.lit(None).cast("array<long>")
    tokens = _counted(pages.withColumns({"root": none, "recur": none}), support)
    hosts = tokens.filter("token = 0 and least <> most").select("host", F.col("pages").alias("all_pages"), F.col("vector").alias("whole"))
    shared = lambda df: df.join(hosts, "host").filter(F.col("pages") >= share * F.col("all_pages"))
    place = (F.col("place") / F.col("pages")).alias("place")
    often = shared(tokens.filter("token <> 0"))
    in_root = (F.col("most_often") == 1) & (F.col("pages") == F.col("all_pages")) & (F.col("vector") == F.col("whole"))
    state = often.groupBy("host", "all_pages", "whole").agg(
        F.array_sort(F.collect_list(F.when(in_root, F.struct(place, "token")))).alias("spine"),  # these and all below: at most the tokens of 1 / share pages
        F.collect_list(F.when(F.col("most_often") > 1, F.col("token"))).alias("recur"),
    )
    settled, roles, staged = _roles(pages, state.filter(F.size("recur") > 0).withColumn("barred", F.expr("cast(array() as array<long>)")), support)
    found = often.filter("most_often = 1")
    for df in roles:
        found = found.unionByName(shared(df.filter("gap >= 0")))
    classes = found.groupBy("host", "vector", "pages").agg(F.min("least").alias("least"), F.max("most").alias("most")).filter("least <> most").select("host", "vector", "pages")
    kind = F.expr(f"if(gap < 0, {ANYWHERE}, 2 * gap + if(most_often > 1, 1, 0))").alias("kind")
    found = found.join(classes, ["host", "vector", "pages"]).select("host", place, "token", kind)
    for df in settled:
        found = found.unionByName(df.select("host", F.inline("spine")).select("host", "place", "token", F.lit(IN_ROOT).alias("kind")))
    found = found.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("place", "token", "kind"))).alias("found"))
    out = durable(found.select("host", F.col("found.token").alias("template"), F.col("found.kind").alias("kinds")))
    discard(pages, tokens, *staged)
    return out


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, len(whole), 256):
            batch = whole.slice(lo, 256)
            found: dict[str, Template] = {}
            got = []
            for text, host, row in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), range(len(batch))):
                if host not in found:
                    found[host] = Template(batch.column(4)[row].as_py() or [], batch.column(5)[row].as_py() or [])
                got.append(extract(text or "", found[host]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.string())], ["page", "url", "text", "slot"])


def html_extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """Per row: its id, its url, text (the article's blocks, joined by an empty line; empty if there is none) and slot
    (the path of the lowest container of all of them; null where there is none).

    Character references are decoded, white space in a block becomes one space. A null html is empty. Rows with no
    or an odd url share the host ''. Repeated rows are extracted alike, and copies alone make no template. An empty
    table gives an empty result; other columns are not read. Pages' tokens are staged as hashes and only sums of hashes are
    shuffled; the templates, one a host, go back to the pages by a join.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    base = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col).cast("string")).alias("host"))
    found = templates(base.select(F.xxhash64("page", "url").alias("page"), "host", "html"), support, share)
    n, size = found.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("host") + 12 * F.size("template")), F.lit(0))).first()
    joined = base.join(broadcast_if_small(found, 1, size + 64 * n), "host", "left").select("page", "url", "html", "host", "template", "kinds")
    out = joined.mapInArrow(_extract, f"page {kinds[0]}, url {kinds[1]}, text string, slot string")
    return out.withColumnsRenamed({"page": id_col, "url": url_col})
