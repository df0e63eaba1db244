"""Main text of web pages: boosted trees over DOM features, decoded down the tree.

A page is parsed into its elements. Boosted trees estimate for each element how likely it is main
text and how likely it is page furniture, from subtree size and density, share of links, depth,
place among its siblings, kind of tag and the tokens of its id, class and role. A dynamic
programme then labels the whole tree at once: below furniture there is only furniture, below main
text only main text or furniture, and the root is neither; of all labellings that keep to this the
likeliest is taken. Text of elements labelled main is put out block by block.

No page comes with a label, so the trees learn from a bounded sample of the pages themselves, with
semantic tags as teachers: what lies in article or main is main text, what lies in nav, footer,
aside, form and the like, or bears a token that names such a part, is furniture. A page without article or main is taught by
density instead: of what is neither furniture nor mostly links, the element that holds nearly all
prose of the page, headings and paragraphs included, is main text. So that they do
not only repeat the teacher, most lessons are given on changed copies: semantic tags renamed to
plain ones, menus, notices, forms and comments put in around and inside the main text, words
wrapped in elements of all kinds, and the main text on its own.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.llm.common import small_batches

FIT_PAGES = 240  # pages at most that the trees learn from
FIT_BYTES = 16 << 20  # and their bytes together
TREES, DEPTH, RATE, BINS = 30, 4, 0.3, 32

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template".split())  # what lies in them is no text of the page
ONE_DEEP = frozenset("button select noscript iframe".split())  # never in themselves: without an end tag before the next one they are empty
OUTSIDE = frozenset("html head body frameset base link meta script style template title".split())  # may lie outside a body
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
MAIN_TAGS = frozenset(["article", "main"])
FURNITURE_TAGS = frozenset(["nav", "footer", "aside", "form", "header", "head", "menu", "dialog", "fieldset", "button", "select", "iframe", "svg", *RAW])
MAIN_TOKENS = frozenset("article content main post entry story body text page blog".split())
FURNITURE_TOKENS = frozenset(
    "nav navbar navigation menu footer header sidebar side ad ads adv advert advertisement sponsor sponsored promo banner cookie cookies consent notice"
    " alert comment comments disqus reply respond share social related recommended popup modal subscribe newsletter breadcrumb breadcrumbs widget form login"
    " search toolbar copyright legal pagination pager tags skip".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
    "button": (("button",), ()), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)),
}
# possessive, so that a stray quote or an unclosed tag costs one look ahead and no backtracking
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"(?:id|class|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TOKEN = re.compile(r"[A-Za-z]+")
EDGES = {name: re.compile(rf"<(/?){name}(?=[\s/>])", re.I) for name in ONE_DEEP}
WRAPS = ("b", "em", "span", "sup", "code", "math", "object", "noscript", "label", "u")  # put around words of copies that teach
PROSE = HEADINGS | {"p", "pre", "blockquote", "ul", "ol", "dl", "figure"}  # kept whole when a page is taught by density

CONTAINER, MAIN, FURNITURE = 0, 1, 2
FEATURES = 26


class Page:
    """Elements in document order with their parents, and the pieces of text between tags."""

    def __init__(self, source: str):
        self.tag, self.parent, self.tokens = ["#root"], [-1], [()]
        self.end = [0]  # one past the last element below
        self.texts: list[tuple[int, int, str]] = []  # element, block, text
        self._parse(source)

    def _parse(self, source: str) -> None:
        stack, at, block = [0], 0, 0
        tag, parent, texts = self.tag, self.parent, self.texts
        ended: dict[str, set[int]] = {}  # where start tags end that their own end tag follows

        def ends(name: str, start: int) -> bool:
            if name not in ended:
                edges = [(m.start(), bool(m[1])) for m in EDGES[name].finditer(source)]
                ended[name] = {a for (a, closes), (_, after) in zip(edges, edges[1:]) if not closes and after}
            return start in ended[name]

        def body() -> None:
            """Text and elements that no tag encloses lie in a body, as a browser has it."""
            tag.append("body")
            parent.append(0)
            self.tokens.append(())
            self.end.append(len(tag))
            stack.append(len(tag) - 1)

        def pop_to(depth: int) -> None:
            while len(stack) > depth:
                self.end[stack.pop()] = len(tag)

        size = len(source)
        while at < size:
            found = MARKUP.search(source, at)
            text = source[at : found.start() if found else size]
            if text and not text.isspace():
                if len(stack) == 1:
                    body()
                texts.append((stack[-1], block, html.unescape(text) if "&" in text else text))
            elif text:
                texts.append((stack[-1], block, " "))
            if not found:
                break
            at = found.end()
            name = found[2]
            if name is None:
                continue
            name = name.lower()
            if found[1]:
                for depth in range(len(stack) - 1, 0, -1):
                    open_ = tag[stack[depth]]
                    if open_ == name:
                        pop_to(depth)
                        break
                    if name not in BLOCK and open_ in BLOCK:
                        break
                block += name in BLOCK
                continue
            if name in BLOCK:
                block += 1
                if name != "html" and name != "body":
                    for depth in range(len(stack) - 1, 0, -1):
                        if tag[stack[depth]] == "p":
                            pop_to(depth)
                            break
                        if tag[stack[depth]] in BLOCK:
                            break
            if name in CLOSES:
                shut, within = CLOSES[name]
                for depth in range(len(stack) - 1, 0, -1):
                    if tag[stack[depth]] in within:
                        break
                    if tag[stack[depth]] in shut:
                        pop_to(depth)
                        break
            attributes = found[3]
            tokens = ()
            if "=" in attributes:
                tokens = tuple(t.lower() for m in ATTRIBUTE.finditer(attributes) for t in TOKEN.findall(m[1] or m[2] or m[3] or ""))
            if len(stack) == 1 and name not in OUTSIDE:
                body()
            number = len(tag)
            tag.append(name)
            parent.append(stack[-1])
            self.tokens.append(tokens)
            self.end.append(number + 1)
            if name == "br":
                texts.append((stack[-1], block, " "))
            if name in VOID:
                continue
            if name in RAW:
                close = re.compile(f"</{name}\\s*>", re.I).search(source, at)
                at = close.end() if close else size
                continue
            if name in ONE_DEEP and not ends(name, found.start()):
                continue
            if not attributes.endswith("/") or name in BLOCK:
                stack.append(number)
        pop_to(0)

    def features(self) -> np.ndarray:
        """One row per element."""
        n = len(self.tag)
        chars, marks, words = np.zeros(n), np.zeros(n), np.zeros(n)
        for node, _, text in self.texts:
            short = text.strip()
            if short:
                chars[node] += len(short)
                words[node] += short.count(" ") + 1
                marks[node] += short.count(".") + short.count(",")
        parent = np.array(self.parent)
        end = np.array(self.end)
        sums = np.zeros((6, n + 1))
        link = np.array([t == "a" for t in self.tag])
        for depth_first, values in enumerate((chars, words, marks, np.ones(n), np.array([t == "p" for t in self.tag], float), link.astype(float))):
            np.cumsum(values, out=sums[depth_first, 1:])
        here = np.arange(n)
        total, total_words, total_marks, below, paragraphs, links = sums[:, end] - sums[:, here]
        in_link = np.zeros(n + 1)
        np.cumsum(np.where(link, total, 0), out=in_link[1:])
        linked = in_link[end] - in_link[here]
        depth = np.zeros(n)
        place, family, alike = np.zeros(n), np.zeros(n), np.zeros(n)
        children: dict[int, int] = {}
        kinds: dict[tuple, int] = {}
        own_main, own_furniture = np.zeros(n), np.zeros(n)
        up_main, up_furniture = np.zeros(n), np.zeros(n)
        kind, up_kind = np.zeros(n), np.zeros(n)
        for k in range(1, n):
            p, name = self.parent[k], self.tag[k]
            depth[k] = depth[p] + 1
            place[k] = children.get(p, 0)
            children[p] = children.get(p, 0) + 1
            kinds[p, name] = kinds.get((p, name), 0) + 1
            for t in self.tokens[k]:
                own_main[k] += t in MAIN_TOKENS
                own_furniture[k] += t in FURNITURE_TOKENS
            up_main[k], up_furniture[k] = up_main[p] + own_main[p], up_furniture[p] + own_furniture[p]
            kind[k] = 3 if name in MAIN_TAGS else -3 if name in FURNITURE_TAGS else 2 if name in HEADINGS else 1 if name == "p" else -1 if name in ("ul", "ol", "li", "a") else 0
            up_kind[k] = kind[p] if abs(kind[p]) == 3 else up_kind[p]
        for k in range(1, n):
            family[k] = children[self.parent[k]]
            alike[k] = kinds[self.parent[k], self.tag[k]]
        whole = max(1.0, total[0])
        up = np.maximum(parent, 0)
        share = total / np.maximum(1, total[up])
        largest = np.zeros(n)
        np.maximum.at(largest, up, np.where(parent >= 0, total, 0))
        return np.stack([
            np.log1p(total), total / whole, share, total / np.maximum(1, largest[up]), linked / np.maximum(1, total), below / (1 + total), np.log1p(below),
            np.log1p(chars), total_words / np.maximum(1, below), total_marks / np.maximum(1, total_words), np.log1p(paragraphs), np.log1p(links), depth,
            place, np.log1p(family), place / np.maximum(1, family), alike / np.maximum(1, family), here / n, (sums[0, here] / whole),
            own_main, own_furniture, up_main, up_furniture, kind, up_kind, total[up] / whole,
        ], axis=1)

    def teacher(self) -> np.ndarray:
        """What semantic tags and tokens say of each element, or density where no tag says main."""
        n = len(self.tag)
        label = np.zeros(n, np.int64)
        for k in range(1, n):
            above, name = label[self.parent[k]], self.tag[k]
            if above == FURNITURE or name in FURNITURE_TAGS or (not name in MAIN_TAGS and any(t in FURNITURE_TOKENS for t in self.tokens[k])):
                label[k] = FURNITURE
            elif above == MAIN or name in MAIN_TAGS:
                label[k] = MAIN
        return label if (label == MAIN).any() else self._by_density(label)

    def _by_density(self, label: np.ndarray) -> np.ndarray:
        """With what is mostly links as furniture too, and the densest element as main text.

        From the root down, a child that holds most of the page's prose is entered unless a heading
        or paragraph beside it would be left out; text kept whole, as in a paragraph, is not entered.
        """
        n = len(self.tag)
        chars, linked = np.zeros(n), np.zeros(n)
        in_link = np.zeros(n, bool)
        for k in range(1, n):
            in_link[k] = self.tag[k] == "a" or in_link[self.parent[k]]
        for node, _, text in self.texts:
            if label[node] != FURNITURE:
                size = len(text.strip())
                chars[node] += size
                linked[node] += size * in_link[node]
        chars, linked = self._below(chars), self._below(linked)
        for k in range(1, n):
            mostly_links = self.tag[k] not in ("html", "body", "a") and not in_link[k] and linked[k] > 0.5 * chars[k]
            if label[self.parent[k]] == FURNITURE or mostly_links:
                label[k] = FURNITURE
        own = np.zeros(n)
        for node, _, text in self.texts:
            if label[node] != FURNITURE:
                own[node] += len(text.strip())
        prose = self._below(own)
        children: list[list[int]] = [[] for _ in range(n)]
        for k in range(1, n):
            if label[k] != FURNITURE:
                children[self.parent[k]].append(k)
        holds = self._below(np.array([t in PROSE and x > 0 for t, x in zip(self.tag, prose)], float))
        at = 0
        while children[at]:
            top = max(children[at], key=lambda k: prose[k])
            beside = any(k != top and holds[k] for k in children[at]) or own[at] > 0.2 * prose[at]
            whole = self.tag[top] not in BLOCK or self.tag[top] in PROSE
            if self.tag[at] not in ("#root", "html") and (whole or beside or prose[top] < 0.6 * prose[at]):
                break
            at = top
        if at and prose[at] > 0:
            for k in range(at, self.end[at]):
                label[k] = FURNITURE if label[k] == FURNITURE else MAIN
        return label

    def _below(self, values: np.ndarray) -> np.ndarray:
        """Sums over each element and all below it."""
        sums = np.zeros(len(values) + 1)
        np.cumsum(values, out=sums[1:])
        return sums[np.array(self.end)] - sums[:-1]

    def decoded(self, main: np.ndarray, furniture: np.ndarray) -> np.ndarray:
        """The likeliest labelling in which furniture holds only furniture and main text holds no container."""
        n = len(self.tag)
        lowest = 1e-6
        neither = np.maximum(lowest, (1 - main) * (1 - furniture))
        score = np.log(np.stack([neither, np.maximum(lowest, main * (1 - furniture)), np.maximum(lowest, furniture * (1 - main))], axis=1)).tolist()
        parent = self.parent
        for k in range(n - 1, 0, -1):
            c, m, f = score[k]
            above = score[parent[k]]
            above[FURNITURE] += f
            above[MAIN] += m if m > f else f
            above[CONTAINER] += max(c, m, f)
        label = [CONTAINER] * n
        for k in range(1, n):
            c, m, f = score[k]
            above = label[parent[k]]
            if above == FURNITURE:
                label[k] = FURNITURE
            elif above == MAIN:
                label[k] = MAIN if m > f else FURNITURE
            else:
                label[k] = CONTAINER if c >= m and c >= f else MAIN if m > f else FURNITURE
        return np.array(label)

    def text(self, label: np.ndarray) -> str:
        """Text of main elements: one line per block, white space as one blank."""
        lines: list[str] = []
        parts: list[str] = []
        now = -1
        for node, block, text in self.texts:
            if block != now:
                lines.append(" ".join("".join(parts).split()))
                parts, now = [], block
            if label[node] == MAIN:
                parts.append(text)
        lines.append(" ".join("".join(parts).split()))
        return "\n".join(line for line in lines if line)


class Trees:
    """Gradient-boosted regression trees of fixed depth for a binary label, on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
        base = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base, self.depth = math.log(base / (1 - base)), depth
        self.feature = np.zeros((trees, (1 << depth) - 1), np.int64)
        self.cut = np.full((trees, (1 << depth) - 1), np.inf)
        self.leaf = np.zeros((trees, 1 << depth))
        z = np.full(len(y), self.base)
        for t in range(trees):
            p = 1 / (1 + np.exp(-z))
            gradient, hessian = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            for level in range(depth):
                width, first = 1 << level, (1 << level) - 1
                best = np.zeros(width)
                chosen = np.full(width, -1)
                where = np.zeros(width, np.int64)
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    key = node * (BINS + 1) + binned[:, f]
                    g = np.bincount(key, gradient, width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)
                    h = np.bincount(key, hessian, width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)
                    g_all, h_all = g[:, -1:], h[:, -1:]
                    gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
                    gain[:, len(c):] = 0
                    top = gain.argmax(axis=1)
                    value = gain[np.arange(width), top]
                    better = value > best + 1e-9
                    best[better], chosen[better], where[better] = value[better], f, top[better]
                for k in np.flatnonzero(chosen >= 0):
                    self.feature[t, first + k], self.cut[t, first + k] = chosen[k], cuts[chosen[k]][where[k]]
                right = x[np.arange(len(y)), self.feature[t, first + node]] > self.cut[t, first + node]
                node = 2 * node + right
            g, h = np.bincount(node, gradient, 1 << depth), np.bincount(node, hessian, 1 << depth)
            self.leaf[t] = rate * g / (h + 1)
            z += self.leaf[t][node]

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = (1 << level) - 1 + node
                node = 2 * node + (x[rows, feature[at]] > cut[at])
            z += leaf[node]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def changed(source: str, seed: int) -> list[str]:
    """Copies of a page that teach: renamed tags, words wrapped in inline elements, furniture put in
    around and inside, and the main text alone."""
    draw = random.Random(seed)
    words = re.findall(r"\w+", re.sub(r"<[^>]*>", " ", source))[:400] or ["x"]

    def some(n: int) -> str:
        return " ".join(draw.choice(words) for _ in range(n))

    def furniture() -> str:
        token = draw.choice(sorted(FURNITURE_TOKENS))
        inner = draw.choice([
            lambda: f"<p>{some(draw.randint(3, 40))}</p>", lambda: "<ul>" + "".join(f'<li><a href="#">{some(2)}</a></li>' for _ in range(draw.randint(2, 8))) + "</ul>",
            lambda: some(draw.randint(2, 25)) + ".", lambda: "".join(f"<div><b>{some(1)}</b><p>{some(draw.randint(5, 60))}.</p></div>" for _ in range(draw.randint(1, 4))),
        ])()
        plain = draw.choice(["div", "section", "div", "aside", "form"])
        return f'<{plain} class="{token}">{inner}</{plain}>'

    def renamed(text: str, main: str, other: str) -> str:
        text = re.sub(r"<(/?)article\b", rf"<\1{main}", text)
        return re.sub(r"<nav\b", f'<{other} class="{draw.choice(["menu", "nav", "navigation"])}"', text).replace("</nav>", f"</{other}>")

    spots = [m.end() for m in re.finditer(r"</(?:p|h1|h2|nav|div|article)>", source)]
    rich = source
    for at in sorted(draw.sample(spots, min(len(spots), 4)), reverse=True):
        rich = rich[:at] + furniture() + rich[at:]
    def wrapped(text: str) -> str:
        spots = [m for m in re.finditer(r"(?<=[ >])[^\W\d_]+(?=[ .,<])", text)]
        for m in sorted(draw.sample(spots, min(len(spots), 6)), key=lambda m: m.start(), reverse=True):
            outer, inner = draw.choice(WRAPS), draw.choice(("", "<i>", "<mi>"))
            text = f"{text[: m.start()]}<{outer}>{inner}{m[0]}{inner.replace('<', '</')}</{outer}>{text[m.end():]}"
        return text

    alone = re.search(r"<article\b.*</article>", source, re.S)
    return [source, rich, wrapped(renamed(rich, "main", "div")), rich.replace("<article>", f'<article class="{draw.choice(sorted(MAIN_TOKENS))}">'),
            *([wrapped(alone[0])] if alone else [])]


class Model:
    def __init__(self, main: Trees, furniture: Trees):
        self.main, self.furniture = main, furniture

    def texts(self, sources: list) -> list[str]:
        pages = [Page(s or "") for s in sources]
        x = np.concatenate([p.features() for p in pages]) if pages else np.zeros((0, FEATURES))
        main, furniture = self.main.probability(x), self.furniture.probability(x)
        out, at = [], 0
        for page in pages:
            n = len(page.tag)
            out.append(page.text(page.decoded(main[at : at + n], furniture[at : at + n])))
            at += n
        return out


def learn(sources: list[str]) -> Model | None:
    """Trees for main text and furniture; None where no page has text to learn from."""
    rows, labels = [], []
    for seed, source in enumerate(sources):
        for copy in changed(source, seed):
            page = Page(copy)
            label = page.teacher()
            if (label == MAIN).any():
                rows.append(page.features())
                labels.append(label)
                if "<article" in copy:  # the same page, its tags told only by what they hold
                    blind = page.features()
                    blind[:, 23:25] = np.where(np.abs(blind[:, 23:25]) == 3, 0, blind[:, 23:25])
                    rows.append(blind)
                    labels.append(label)
    if not rows:
        return None
    x, y = np.concatenate(rows), np.concatenate(labels)
    return Model(Trees(x, (y == MAIN).astype(float)), Trees(x, (y == FURNITURE).astype(float)))


def fit(pages: DataFrame, n: int = FIT_PAGES, most: int = FIT_BYTES) -> Model | None:
    """Learn from the ``n`` pages that come first by a hash of page_id, as many of them as fit into
    ``most`` bytes together. Only ids and sizes are sorted; of a repeated id one page counts."""
    known = pages.select("page_id", "html").where("page_id is not null and html is not null")
    sizes = known.groupBy("page_id").agg(F.max(F.octet_length("html")).alias("size"))
    first = sizes.where(F.col("size") <= most).orderBy(F.xxhash64("page_id", F.lit("fit")), "page_id").limit(n)
    chosen, room = [], most
    for r in first.collect():
        if r["size"] <= room:
            chosen.append(r["page_id"])
            room -= r["size"]
    if not chosen:
        return None
    found = known.where(F.col("page_id").isin(chosen)).groupBy("page_id").agg(F.min("html").alias("html")).collect()
    texts = {r["page_id"]: r["html"] for r in found}
    return learn([texts[k] for k in chosen])


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages, from its whole html.

    A null html is an empty page; a page without main text gives the empty string. Where nothing
    could be learned, because no sampled page has text in an element, no page has main text. Rows repeated
    get equal answers. No rows give no rows.
    """
    small_batches(pages.sparkSession)
    learned = model or fit(pages)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources, found = batch.column(2).to_pylist(), []
            for at in range(0, len(sources), 128):
                part = sources[at : at + 128]
                found += learned.texts(part) if learned else [""] * len(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(
        extract, "page_id long, url string, text string, n_chars long")
