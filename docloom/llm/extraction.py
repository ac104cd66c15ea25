"""Main text of web pages, by template deduction over the pages of a host.

A page is read as a row of tokens: tags and blocks of text, each told apart by its role, the chain of
elements around it. Tokens of a host with the same occurrence vector (how often each page has them)
form an equivalence class. Vectors are compared by sums of 120 hashed bits for each page and count,
which add up over any number of tasks, so that no task sees all pages of a host. The class of tokens that
come once a page and has the most of them is the root of the host's template; a second pass over the
token rows proves its order, and drops what breaks it. Further classes are valid if they repeat in
one order and stay inside one gap of the root, where they nest. What lies between the template's tokens
are slots: the main text is in those that elements of articles open, or else in those that hold running text
over all pages of the host. Menus, adverts, forms and the like are left out by element and by name,
and so is text that every page of a host repeats.

A host with few pages has no vectors worth the name; its pages are judged one by one, by the same
rules over slots made of elements.
"""

from __future__ import annotations

import html as references
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.store import stored

# Pages that a host needs for a template, share of them that a class needs, and share that may break it.
PAGES, SUPPORT, BROKEN = 8, 0.5, 0.01
# Bytes of templates that are sent to every executor; beyond, pages are joined with theirs.
BROADCAST_BYTES = 32 << 20
PAGES_PER_PART = 2000
# A slot of running text: share of characters in links, characters of a block, share of the best slot.
LINKED, BLOCK_CHARS, OF_BEST = 0.4, 25, 0.2

# Elements by what they do to the text around and inside them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option "
    "p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
SKIPPED = frozenset(
    "nav footer aside form button select option textarea dialog menu script style noscript template svg math "
    "iframe object canvas audio video head title".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An opening tag closes an open one of these, if nothing but inline elements is between.
CLOSES = {
    "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]), "dt": frozenset(["dd", "dt"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "tr": frozenset(["tr", "td", "th"]),
    "option": frozenset(["option"]),
}
# Words of class, id and role that name what is not the article, and what is.
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager sidebar sidebars rail "
    "footer masthead topbar toolbar banner banners cookie cookies consent gdpr notice notices alert alerts "
    "disclaimer popup modal overlay newsletter subscribe subscription signup login register search share "
    "sharing social related recommended recommendations trending widget widgets comment comments "
    "commentlist reply replies respond disqus form complementary contentinfo aside copyright skip".split()
)
HEADER_WORDS = frozenset(["header"])
ARTICLE_WORDS = frozenset(["articlebody", "postbody", "storybody", "entrycontent", "articlecontent", "postcontent", "maincontent"])
_TAG = re.compile(
    r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|[!?/][^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_PLAIN, _MAIN, _ARTICLE = 0, 1, 2


class Element:
    """An open element: its name, the hash of its chain of names, and what its text counts as."""

    __slots__ = ("name", "chain", "other", "level", "link")

    def __init__(self, name: str, chain: int, other: bool, level: int, link: bool):
        self.name, self.chain, self.other, self.level, self.link = name, chain, other, level, link


# Roles that a task has met; bounded.
_roles: dict[tuple[str, str], tuple[str, bool, bool, int]] = {}


def _role(name: str, attributes: str) -> tuple[str, bool, bool, int]:
    """As ``_read_role``, each once."""
    known = _roles.get((name, attributes))
    if known is None:
        if len(_roles) >= 20_000:
            _roles.clear()
        known = _roles[name, attributes] = _read_role(name, attributes)
    return known


def _read_role(name: str, attributes: str) -> tuple[str, bool, bool, int]:
    """Name with classes and id, whether it is beside the article, whether a header, and its level."""
    given = {}
    if attributes:
        for key, *values in _ATTRIBUTE.findall(attributes):
            given.setdefault(key.lower(), next((v for v in values if v), ""))
    shown = f"{given.get('class', '')} {given.get('id', '')}"
    words = {w.lower() for w in _WORD.findall(f"{shown} {given.get('role', '')}")}
    packed = re.sub(r"[^a-z ]", "", f"{shown} {given.get('itemprop', '')}".lower()).split()
    other = name in SKIPPED or bool(attributes and _HIDDEN.search(attributes))
    if name not in ("html", "body", "main") and words & OTHER_WORDS and not words & {"with", "has", "no"}:
        other = True
    level = _ARTICLE if name == "article" or "articlebody" in packed else _PLAIN
    if name == "main" or "main" in given.get("role", "").split() or ARTICLE_WORDS & set(packed):
        level = max(level, _MAIN)
    head = name == "header" or (bool(words & HEADER_WORDS) and name not in ("html", "body", "main", "article"))
    # Numbers in classes and ids differ from page to page.
    return f"{name} {re.sub(r'[0-9]+', '0', ' '.join(sorted(shown.split())))}", other, head, level


class Page:
    """Tokens of a page and its blocks of text.

    ``tokens`` are role hashes in order. Block ``i`` is token ``places[i]``, ``blocks[i]`` its text,
    ``linked[i]`` its characters in links, ``others[i]`` true beside the article, ``levels[i]`` how surely it
    is inside one, ``heads[i]`` true for a heading, and ``chains[i]`` its chain of elements.
    """

    def __init__(self, html: str | None):
        self.tokens: list[int] = []
        self.places: list[int] = []
        self.blocks: list[str] = []
        self.linked: list[int] = []
        self.others: list[bool] = []
        self.levels: list[int] = []
        self.heads: list[bool] = []
        self.chains: list[int] = []
        self.stack = [Element("", 1, False, _PLAIN, False)]
        self.open: dict[str, int] = {}
        self.parts: list[str] = []
        self.in_link = 0
        if html:
            self._read(html)

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            tag = _TAG.search(html, at)
            begin = tag.start() if tag else end
            if begin > at:
                self._text(html[at:begin])
            if tag is None:
                break
            at = tag.end()
            close, name, rest = tag.group(1, 2, 3) if tag.group(2) else tag.group(4, 5, 6)
            if not name:
                continue
            name = name.lower()
            if close:
                self._close(name)
                continue
            self._open(name, rest.strip())
            if name in RAW:
                stop = re.compile(rf"</{name}[\s/>]", re.I).search(html, at)
                at = stop.start() if stop else end
        self._flush()

    def _text(self, raw: str) -> None:
        shown = references.unescape(raw) if "&" in raw else raw
        self.parts.append(shown)
        if self.stack[-1].link:
            self.in_link += len(shown.strip())

    def _flush(self) -> None:
        """End the block that is being read."""
        if not self.parts:
            return
        shown = " ".join("".join(self.parts).split())
        self.parts, linked, self.in_link = [], self.in_link, 0
        if not shown:
            return
        holder = next((e for e in reversed(self.stack) if e.name in BLOCKS or not e.name), self.stack[0])
        self.places.append(len(self.tokens))
        self.tokens.append(_signed(xxhash.xxh3_64_intdigest(shown.encode("utf-8", "surrogatepass"), holder.chain)))
        self.blocks.append(shown)
        self.linked.append(min(linked, len(shown)))
        self.others.append(holder.other)
        self.levels.append(holder.level)
        self.heads.append(holder.name in HEADINGS)
        self.chains.append(_signed(holder.chain))

    def _open(self, name: str, rest: str) -> None:
        if name == "br":
            self.parts.append(" ")
        block = name in BLOCKS
        if block:
            self._flush()
            self._imply(CLOSES.get(name, frozenset()) | {"p"})
        above = self.stack[-1]
        label, other, head, level = _role(name, rest)
        # A header inside an article holds its title.
        other = above.other or other or (head and above.level == _PLAIN)
        chain = xxhash.xxh3_64_intdigest(label.encode("utf-8", "surrogatepass"), above.chain)
        self.tokens.append(_signed(chain))
        if name in VOID or rest.endswith("/") and not block:
            return
        if other and not above.other and not block:
            # An inline element beside the article is a block of its own.
            self._flush()
        self.stack.append(Element(name, chain, other, max(above.level, level), above.link or name == "a"))
        self.open[name] = self.open.get(name, 0) + 1

    def _imply(self, names: frozenset[str]) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].name in names:
                self._pop(depth)
                return
            if self.stack[depth].name in BLOCKS:
                return

    def _pop(self, depth: int) -> None:
        for e in self.stack[depth:]:
            self.open[e.name] -= 1
        del self.stack[depth:]

    def _close(self, name: str) -> None:
        if name in BLOCKS:
            self._flush()
        if not self.open.get(name):
            return
        depth = len(self.stack) - 1
        while self.stack[depth].name != name:
            depth -= 1
        last = self.stack[depth]
        if last.other and not self.stack[depth - 1].other:
            self._flush_into(depth)
        self.tokens.append(_signed(last.chain ^ 0x5BD1E995))
        self._pop(depth)

    def _flush_into(self, depth: int) -> None:
        """End a block as text of the inline element at ``depth``, which is beside the article."""
        count = len(self.blocks)
        self._flush()
        if len(self.blocks) > count:
            self.others[-1] = True


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def host_of(url: str | None) -> str:
    """Host name of an address, in lower case; empty if there is none."""
    found = _HOST.match(url) if url else None
    return found.group(1).lower() if found else ""


def _marks(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Four numbers of 30 bits for each count of a page; a token's sums of these stand for its vector."""
    raw = xxhash.xxh3_128_digest(tokens.tobytes())
    some, at = np.unique(counts, return_inverse=True)
    marks = [np.frombuffer(xxhash.xxh3_128_digest(raw + n.tobytes()), "<u4") for n in some]
    return (np.array(marks, np.int64).reshape(-1, 4) & 0x3FFFFFFF)[at]


class Template:
    """A host's template, from its frequent tokens and what the second pass found about them.

    ``tokens`` are ``(token, vector, pages, total, first, text)``; ``found`` are
    ``(kind, gap, token, pages, low, high, chars, linked, blocks)`` rows as ``_observe`` gives them.
    """

    def __init__(self, pages: int, tokens: list, found: list | None):
        classes: dict = {}
        for t in tokens:
            classes.setdefault((t["vector"], t["pages"], t["total"]), []).append(t)
        once = [(k, v) for k, v in classes.items() if k[1] == k[2]]
        # The most tokens win, then the most pages.
        root = max(once, key=lambda c: (sum(not t["text"] for t in c[1]), c[0][1], c[0][0]), default=(None, []))
        ordered = sorted(root[1], key=lambda t: (t["first"], t["token"]))
        self.pages = root[0][1] if ordered else 0
        self.everywhere = self.pages == pages
        broken = {r["token"] for r in found or () if r["kind"] == 0 and r["pages"] > BROKEN * self.pages}
        held = [t["token"] not in broken for t in ordered]
        # Gaps by the tokens of the whole class, and the gap each becomes without broken ones.
        self.merged = np.concatenate(([0], np.cumsum(held))).astype(int)
        self.root = [t["token"] for t, h in zip(ordered, held) if h] if found is not None else [t["token"] for t in ordered]
        self.constant = {t["token"] for t in ordered if t["text"]} if self.everywhere else set()
        self.classes = {
            t["token"]: i
            for i, (k, v) in enumerate(sorted(classes.items(), key=lambda c: c[0]))
            if k != root[0] and len(v) > 1 for t in v
        }
        self.orders = {}
        for k, v in classes.items():
            if k != root[0] and len(v) > 1:
                order = [t["token"] for t in sorted(v, key=lambda t: (t["first"], t["token"]))]
                self.orders[self.classes[order[0]]] = np.array(order)
        self.nested: set[int] = set()
        self.stats: dict = {}
        if found is not None:
            self._nest(found)
        self.ranks = {t: i + 1 for i, t in enumerate(self.root)}

    def _nest(self, found: list) -> None:
        bad, gaps = set(), {}
        for r in found:
            if r["kind"] == 1:
                if r["pages"] > BROKEN * self.pages:
                    bad.add(r["token"])
            elif r["kind"] == 2:
                gaps[r["token"]] = (self.merged[r["low"]], self.merged[r["high"]])
        valid = {c for c, (low, high) in gaps.items() if low == high and c not in bad}
        self.nested = {t for t, c in self.classes.items() if c in valid}
        for r in found:
            if r["kind"] == 3:
                slot = (int(self.merged[r["gap"]]), r["token"] if r["token"] in self.nested else 0)
                old = self.stats.get(slot, (0, 0, 0))
                self.stats[slot] = tuple(x + y for x, y in zip(old, (r["chars"], r["linked"], r["blocks"])))

    def slots(self, page: Page) -> list[tuple[int, int]]:
        """Slot of each block: the gap of the root, and the nested token before it in that gap."""
        out, gap, inner, block = [], 0, 0, 0
        for i, token in enumerate(page.tokens):
            if block < len(page.places) and page.places[block] == i:
                out.append((gap, inner))
                block += 1
            if token in self.ranks:
                gap, inner = self.ranks[token], 0
            elif token in self.nested:
                inner = token
        return out


class Templates:
    """Templates of hosts, each read from its row once; a bounded number is kept."""

    def __init__(self):
        self.known: dict[str, Template | None] = {}

    def of(self, host: str, column: pa.Array, place: int) -> Template | None:
        if host not in self.known:
            if len(self.known) >= 512:
                self.known.clear()
            given = column[place].as_py()
            self.known[host] = given and Template(given["pages"], given["tokens"], given.get("found"))
        return self.known[host]


def _running(stats: dict) -> set:
    """Slots that hold running text, from (characters, those in links, blocks) of each."""
    plain = {slot: v for slot, v in stats.items() if v[0] and v[1] < LINKED * v[0]}
    # Where all text is short, short text is the article.
    score = {s: v[0] for s, v in plain.items() if v[0] >= BLOCK_CHARS * v[2]} or {s: v[0] for s, v in plain.items()}
    best = max(score.values(), default=0)
    return {slot for slot, chars in score.items() if chars >= OF_BEST * best}


def _unmarked(page: Page, template: Template | None, use: list[int]) -> list[int]:
    """Blocks among ``use`` of the article of a page whose elements do not name one."""
    if template and template.stats:
        slots = template.slots(page)
        good = _running(template.stats)
        chosen = {i for i in use if slots[i] in good}
    else:
        slots, stats = page.chains, {}
        for i in use:
            old = stats.get(slots[i], (0, 0, 0))
            stats[slots[i]] = (old[0] + len(page.blocks[i]), old[1] + page.linked[i], old[2] + 1)
        good = _running(stats)
        held = [i for i in use if slots[i] in good]
        # Lists, quotations and captions between running text belong to it, menus do not.
        menus = {s for s, v in stats.items() if v[1] >= LINKED * v[0]}
        chosen = {i for i in use if held and held[0] <= i <= held[-1] and slots[i] not in menus}
    out, after = [], False
    for i in reversed(use):
        # A heading goes with what it stands above.
        after = i in chosen or (page.heads[i] and after)
        if after:
            out.append(i)
    return out[::-1]


def main_text(page: Page, template: Template | None) -> str:
    """Blocks of the article, one a line."""
    use = [i for i in range(len(page.blocks)) if not page.others[i]]
    level = max((page.levels[i] for i in use), default=_PLAIN)
    chosen = [i for i in use if page.levels[i] == level] if level else _unmarked(page, template, use)
    if template:
        own = [i for i in chosen if page.tokens[page.places[i]] not in template.constant]
        # Where nothing else is left the repeated text is the article.
        chosen = own or chosen
    return "\n".join(page.blocks[i] for i in chosen)


def _increasing(ranks: list[int]) -> set[int]:
    """Places of one longest increasing run of ``ranks``."""
    import bisect

    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(ranks)
    for i, r in enumerate(ranks):
        k = bisect.bisect_left(tails, r)
        if k == len(tails):
            tails.append(r)
            at.append(i)
        else:
            tails[k], at[k] = r, i
        before[i] = at[k - 1] if k else -1
    out, i = set(), at[-1] if at else -1
    while i >= 0:
        out.add(i)
        i = before[i]
    return out


def _observe(template: Template, row: dict) -> list[tuple]:
    """What one page says: root tokens out of order (kind 0), classes out of order (1), gaps in which a class
    occurs (2), and characters of slots (3), as ``(kind, gap, token, low, high, chars, linked, blocks)``."""
    out = []
    tokens = row["tokens"]
    ranks = [(template.ranks[t], t) for t in tokens if t in template.ranks]
    if any(x >= y for (x, _), (y, _) in zip(ranks, ranks[1:])):
        good = _increasing([r for r, _ in ranks])
        out += [(0, 0, t, 0, 0, 0, 0, 0) for i, (_, t) in enumerate(ranks) if i not in good]
    seen: dict[int, list] = {}
    low: dict[int, list[int]] = {}
    slots: dict = {}
    gap = inner = block = 0
    for i, token in enumerate(tokens):
        if block < len(row["places"]) and row["places"][block] == i:
            if not row["others"][block]:
                old = slots.get((gap, inner), (0, 0, 0))
                slots[gap, inner] = (old[0] + row["chars"][block], old[1] + row["linked"][block], old[2] + 1)
            block += 1
        if token in template.ranks:
            gap, inner = template.ranks[token], 0
        elif (c := template.classes.get(token)) is not None:
            inner = token
            seen.setdefault(c, []).append(token)
            low.setdefault(c, [gap, gap])[1] = gap
    for c, found in seen.items():
        order = template.orders[c]
        whole, rest = divmod(len(found), len(order))
        if rest or found != np.tile(order, whole).tolist():
            out.append((1, 0, c, 0, 0, 0, 0, 0))
        out.append((2, 0, c, *low[c], 0, 0, 0))
    out += [(3, g, t, 0, 0, *v) for (g, t), v in slots.items()]
    return out


_SKELETON = "host string, tokens array<long>, places array<int>, others array<boolean>, chars array<int>, linked array<int>"
_TOKEN_ROW = "host string, token long, n long, first double, text boolean, v0 long, v1 long, v2 long, v3 long"
_OBSERVED = "host string, kind int, gap int, token long, low int, high int, chars long, linked long, blocks long"


def _with_templates(rows: DataFrame, templates: DataFrame, hosts: DataFrame) -> DataFrame:
    """Rows that have a ``host`` with that host's ``template``, null where there is none.

    Few templates are sent to every executor. Beyond ``BROADCAST_BYTES`` rows are joined, those of a host
    dealt to as many parts as its pages need.
    """
    size = templates.agg(F.sum(F.length(F.to_json(F.col("template"))))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(templates), "host", "left")
    parts = hosts.select("host", F.ceil(F.col("pages") / PAGES_PER_PART).cast("int").alias("parts"))
    spread = templates.join(parts, "host").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = rows.join(parts, "host").withColumn("part", F.floor(F.rand(7) * F.col("parts")).cast("int"))
    return dealt.join(spread.drop("parts"), ["host", "part"], "left").drop("part", "parts")


def _templates(spark, skeletons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(host, template)`` of hosts with enough pages, and ``(host, pages)`` of all."""
    hosts = stored(skeletons.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "page-hosts")

    def occurrences(batches):
        for batch in batches:
            found = []
            hosts_, sizes = batch.column("host"), []
            for tokens, places in zip(batch.column("tokens"), batch.column("places")):
                row = tokens.values.to_numpy()
                token, first, n = np.unique(row, return_index=True, return_counts=True)
                found.append((token, n, first, np.isin(first, places.values.to_numpy()), _marks(row, n)))
                sizes.append(len(token))
            if not found:
                continue
            token, n, first, text, marks = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays([
                hosts_.take(pa.array(np.repeat(np.arange(len(sizes)), sizes))), pa.array(token), pa.array(n),
                pa.array(first.astype(np.float64)), pa.array(text), *[pa.array(marks[:, i]) for i in range(4)],
            ], ["host", "token", "n", "first", "text", "v0", "v1", "v2", "v3"])

    # One host or one token may have any number of rows: all of this adds up before it travels.
    summed = skeletons.mapInArrow(occurrences, _TOKEN_ROW).groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum("n").alias("total"), F.sum("first").alias("first"),
        F.max("text").alias("text"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(4)],
    )
    large = hosts.where(F.col("pages") >= PAGES)
    # A host has no more frequent tokens than the mean of its pages divided by the support.
    frequent = summed.join(large, "host").where(F.col("n_pages") >= SUPPORT * F.col("pages"))
    vector = F.concat_ws(":", *[F.col(f"v{i}").cast("string") for i in range(4)])
    entry = F.struct(
        "token", vector.alias("vector"), F.col("n_pages").alias("pages"), "total",
        (F.col("first") / F.col("n_pages")).alias("first"), "text",
    )
    classes = stored(frequent.groupBy("host").agg(
        F.struct(F.max("pages").alias("pages"), F.sort_array(F.collect_list(entry)).alias("tokens")).alias("template")
    ), "page-classes")

    def observe(batches):
        known = Templates()
        for batch in batches:
            out = []
            rows = batch.drop_columns(["template"]).to_pylist()
            for i, row in enumerate(rows):
                template = known.of(row["host"], batch.column("template"), i)
                if template is not None:
                    out += [(row["host"], *o) for o in _observe(template, row)]
            names = [f.split()[0] for f in _OBSERVED.split(", ")]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 3]
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    seen = _with_templates(skeletons, classes, hosts).mapInArrow(observe, _OBSERVED)
    observed = seen.groupBy("host", "kind", "gap", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.sum("blocks").alias("blocks"),
    )
    entry = F.struct("kind", "gap", "token", "pages", "low", "high", "chars", "linked", "blocks")
    found = observed.groupBy("host").agg(F.sort_array(F.collect_list(entry)).alias("found"))
    none = F.array().cast(found.schema["found"].dataType)
    whole = classes.join(found, "host", "left").select(
        "host", F.struct("template.pages", "template.tokens", F.coalesce("found", none).alias("found")).alias("template")
    )
    return stored(whole, "page-templates"), hosts


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def extract(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """The columns of ``pages`` without the html, and ``text`` and ``n_chars`` of its article.

    Blocks are joined by line feeds; inside a block character references are decoded and white space is one
    space. ``text`` and ``n_chars`` replace columns of these names. A null or empty page, and one without an
    article, has an empty text. Pages without a host in their address form one host. Repeated rows are
    pages of their own; an empty table gives an empty one.
    """
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    names = [f"c{i}" for i in range(len(kept))]
    body = [pages[_quoted(c)].alias(n) for c, n in zip(kept, names)]
    host = F.lower(F.regexp_extract(F.coalesce(pages[_quoted(url)], F.lit("")), _HOST.pattern, 1))
    source = pages.select(F.struct(F.lit(0).alias("_"), *body).alias("row"), host.alias("host"), pages[_quoted(html)].alias("html"))

    def scan(batches):
        for batch in batches:
            found = [Page(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("host"), pa.array([p.tokens for p in found], pa.list_(pa.int64())),
                pa.array([p.places for p in found], pa.list_(pa.int32())),
                pa.array([p.others for p in found], pa.list_(pa.bool_())),
                pa.array([[len(b) for b in p.blocks] for p in found], pa.list_(pa.int32())),
                pa.array([p.linked for p in found], pa.list_(pa.int32())),
            ], ["host", "tokens", "places", "others", "chars", "linked"])

    skeletons = stored(source.select("host", "html").mapInArrow(scan, _SKELETON), "page-skeletons")
    templates, hosts = _templates(pages.sparkSession, skeletons)

    def take(batches):
        known = Templates()
        for batch in batches:
            texts = [
                main_text(Page(html), known.of(host, batch.column("template"), i))
                for i, (host, html) in enumerate(zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()))
            ]
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())
            ], ["row", "text", "n_chars"])

    joined = _with_templates(source, templates, hosts).select("row", "host", "html", "template")
    schema = source.select("row").withColumn("text", F.lit("")).withColumn("n_chars", F.lit(0).cast("long")).schema
    done = joined.mapInArrow(take, schema)
    return done.select(*[F.col("row")[n].alias(c) for c, n in zip(kept, names)], "text", "n_chars")


def extraction_query(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages)
