"""Block trees of HTML pages and the features of their nodes.

A node is a block-level element; inline markup belongs to the text of its block. Text beside block
children gets a block of its own (tag ``#text``), so every text is in just one childless block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p"
    " pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is not text of the page. Up to ``textarea`` it isn't markup either.
RAW = ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes")
HIDDEN = frozenset((*RAW, "noscript", "template", "svg", "select", "button", "head"))
FIELDS = frozenset(("input", "select", "button", "textarea", "label"))
BREAKS = frozenset(("br", "hr", "wbr", "img"))
#: An open element of the first kind ends where one of the second kind begins.
ENDED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "tr": {"tr", "tbody", "tfoot"},
}
SCOPES = frozenset(("ul", "ol", "menu", "dl", "table", "body", "html"))
TAG_KINDS = [
    *("html", "body", "article", "main", "section", "div", "p", "h1", "h2", "ul", "li", "nav", "header"),
    *("footer", "aside", "form", "table", "blockquote", "figure", "pre", "dl", "#text", "other"),
]
KIND = {
    **{tag: tag for tag in TAG_KINDS},
    **dict.fromkeys(("h3", "h4", "h5", "h6", "hgroup"), "h2"),
    **dict.fromkeys(("ol", "menu"), "ul"),
    **dict.fromkeys(("tbody", "thead", "tfoot", "tr", "td", "th", "caption"), "table"),
    **dict.fromkeys(("dt", "dd"), "dl"),
    **dict.fromkeys(("fieldset", "legend"), "form"),
    "figcaption": "figure",
}


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    tokens: tuple[str, ...] = ()
    text: str = ""
    link_chars: int = 0
    fields: int = 0
    children: list[int] = field(default_factory=list)


def attribute_tokens(attributes: str) -> tuple[str, ...]:
    """Lower-case words of the attributes that say what an element is for."""
    found = []
    for match in ATTRIBUTE.finditer(attributes):
        name = match[1].lower()
        if name in ("class", "id", "role", "itemprop", "aria-label", "data-role"):
            value = match[2] or match[3] or match[4] or ""
            found += [word.lower() for word in WORDS.findall(value)]
    return tuple(found)


def parse(page: str) -> list[Node]:
    """The page's blocks in page order, the root first, by tolerant rules: missing, superfluous and
    crossed tags are accepted, and a page without markup is one block."""
    nodes = [Node("html", -1)]
    stack = [0]
    pieces: list[str] = []
    state = {"link": 0, "links": 0, "fields": 0}

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        top = nodes[stack[-1]]
        if text:
            nodes.append(Node("#text", stack[-1], (), text, min(state["links"], len(text))))
            top.children.append(len(nodes) - 1)
        top.fields += state["fields"]
        pieces.clear()
        state["links"] = state["fields"] = 0

    def close(depth: int) -> None:
        flush()
        del stack[depth:]
        state["link"] = 0

    at, hidden = 0, []
    inside: Counter[str] = Counter()  # blocks opened within what is hidden
    for match in TOKEN.finditer(page):
        if match.start() < at:
            continue  # within raw text
        if match.start() > at and not hidden:
            text = page[at : match.start()]
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            if state["link"]:
                state["links"] += len(text.strip())
        at = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag, ending = tag.lower(), match[1]
        if hidden:
            if ending and tag in hidden:
                del hidden[hidden.index(tag) :]
            elif not ending and tag in HIDDEN and not match[3].endswith("/"):
                hidden.append(tag)
            elif tag == "body":
                hidden.clear()
            elif tag in BLOCKS and not ending:
                inside[tag] += 1
            elif tag in BLOCKS and inside[tag]:
                inside[tag] -= 1
            elif tag in BLOCKS and any(nodes[i].tag == tag for i in stack[1:]):
                hidden.clear()  # the block around it ends
            if not hidden:
                inside.clear()
            if hidden and not (tag in RAW and not ending):
                continue
        if tag in FIELDS and not ending:
            state["fields"] += 1
        if not ending and tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            if tag not in hidden:
                hidden.append(tag)
            continue
        if tag in HIDDEN:
            if not ending and not match[3].endswith("/"):
                hidden.append(tag)
            continue
        if tag == "a":
            state["link"] = 0 if ending else 1
        elif tag in BREAKS:
            pieces.append(" ")
        if tag not in BLOCKS:
            if tag == "hr":
                flush()
            continue
        open_tags = [nodes[i].tag for i in stack]
        if ending:
            if tag in open_tags[1:]:
                close(len(open_tags) - 1 - open_tags[::-1].index(tag))
            else:
                flush()
            continue
        if tag in ("html", "body") and tag in open_tags:
            nodes[stack[open_tags.index(tag)]].tokens += attribute_tokens(match[3])
            continue
        depth = len(stack)
        for back in range(len(stack) - 1, 0, -1):
            if open_tags[back] == "p" or tag in ENDED_BY.get(open_tags[back], ()):
                depth = back
            elif open_tags[back] in SCOPES:
                break
        close(depth)
        nodes.append(Node(tag, stack[-1], attribute_tokens(match[3]) if match[3] else ()))
        nodes[stack[-1]].children.append(len(nodes) - 1)
        stack.append(len(nodes) - 1)
    if at < len(page) and not hidden:
        pieces.append(html.unescape(page[at:]))
    flush()
    return _merged(nodes)


def _merged(nodes: list[Node]) -> list[Node]:
    """A block whose only content is one text takes it; blocks without any content go."""
    for node in reversed(nodes):
        if len(node.children) == 1 and nodes[node.children[0]].tag == "#text" and node.parent >= 0:
            child = nodes[node.children[0]]
            node.text, node.link_chars = child.text, child.link_chars
            child.parent = -2
            node.children = []
    filled = [False] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        if node.parent != -2 and (node.text or node.fields or any(filled[c] for c in node.children)):
            filled[i] = True
    filled[0] = True
    number, kept = {}, []
    for i, node in enumerate(nodes):
        if filled[i]:
            number[i] = len(kept)
            kept.append(node)
    for node in kept:
        node.parent = number.get(node.parent, -1)
        node.children = [number[c] for c in node.children if filled[c]]
    return kept


NUMERIC = (
    "depth text own links density punctuation digits mean_text paragraphs items fields blocks before"
    " share siblings place same_tag sibling_text previous_text next_text parent_share own_content"
    " own_boilerplate above_content above_boilerplate"
).split()
N_FEATURES = len(NUMERIC) + len(TAG_KINDS)
TAG_NUMBER = {tag: TAG_KINDS.index(kind) for tag, kind in KIND.items()}


def node_features(nodes: list[Node], odds: dict[str, tuple[float, float]]):
    """A row per node: densities and counts of the subtree, depth, place and sibling statistics, how
    the words of its attributes and of those above speak (``odds``: for content, for boilerplate),
    and its kind of tag."""
    import numpy as np

    n = len(nodes)
    parent = np.array([node.parent for node in nodes], np.int64)
    own = np.array([len(node.text) for node in nodes], float)
    tag = np.array([TAG_NUMBER.get(node.tag, len(TAG_KINDS) - 1) for node in nodes])
    texts = [node.text for node in nodes]
    base = np.stack(
        [
            own,
            np.array([node.link_chars for node in nodes], float),
            np.ones(n),
            np.array([sum(map(t.count, ".,;:!?")) if t else 0 for t in texts], float),
            np.array([sum(map(t.count, "0123456789")) if t else 0 for t in texts], float),
            (tag == TAG_NUMBER["p"]).astype(float),
            (tag == TAG_NUMBER["li"]).astype(float),
            np.array([node.fields for node in nodes], float),
            (own > 0).astype(float),
        ],
        axis=1,
    )
    before = np.concatenate([[0.0], np.cumsum(own)[:-1]])
    total, depth = base.copy(), np.zeros(n)
    for i in range(n - 1, 0, -1):  # children come after their parents
        total[parent[i]] += total[i]
    speak = np.zeros((n, 2))
    above = np.zeros((n, 2))
    for i, node in enumerate(nodes):
        if node.tokens:
            known = [odds[t] for t in node.tokens if t in odds]
            if known:
                speak[i] = np.max(known, axis=0)
        if i:
            depth[i] = depth[parent[i]] + 1
            above[i] = np.maximum(above[parent[i]], speak[parent[i]])
    siblings, place, same, sib_text = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    previous, following = np.zeros(n), np.zeros(n)
    for node in nodes:
        kids = node.children
        if not kids:
            continue
        lengths = total[kids, 0]
        siblings[kids] = len(kids)
        place[kids] = np.arange(len(kids)) / len(kids)
        same[kids] = np.bincount(tag[kids], minlength=len(TAG_KINDS))[tag[kids]] / len(kids)
        sib_text[kids] = lengths.mean()
        previous[kids[1:]] = lengths[:-1]
        following[kids[:-1]] = lengths[1:]
    chars = np.maximum(total[:, 0], 1)
    page = max(total[0, 0], 1)
    numeric = [
        depth,
        np.log1p(total[:, 0]),
        np.log1p(own),
        total[:, 1] / chars,
        np.log1p(total[:, 0] / total[:, 2]),
        total[:, 3] / chars,
        total[:, 4] / chars,
        np.log1p(total[:, 0] / np.maximum(total[:, 8], 1)),
        np.log1p(total[:, 5]),
        np.log1p(total[:, 6]),
        np.log1p(total[:, 7]),
        np.log1p(total[:, 2]),
        before / page,
        total[:, 0] / page,
        np.log1p(siblings),
        place,
        same,
        np.log1p(sib_text),
        np.log1p(previous),
        np.log1p(following),
        np.where(parent >= 0, chars / chars[np.maximum(parent, 0)], 1),
        speak[:, 0],
        speak[:, 1],
        above[:, 0],
        above[:, 1],
    ]
    return np.concatenate([np.stack(numeric, axis=1), np.eye(len(TAG_KINDS))[tag]], axis=1).astype(np.float32)
