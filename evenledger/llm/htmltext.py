"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: runs of text between block-level tags, with the open tags around them. A block's
features are its ancestors' tags and class, id and role words, its parent and nearest section, and counts over its text. The field has two
states (article or not), is trained by gradient ascent on the likelihood of labelled pages and decoded by Viterbi.
The labelled pages are composed here from page parts of many kinds, in every order and nesting that sites use.
"""

from __future__ import annotations

import html
import random
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenledger.llm.common import small_batches

PAGES, STEPS, RATE, DECAY = 500, 250, 0.5, 1e-4
TEXT_BYTES = 4 << 20

#: Fixed values of HTML: tags without content, tags inside a line of text, tags whose content is no text, and tags
#: that end an open one of the same list.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label map mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
HIDDEN = set("head title script style noscript template svg math iframe object".split())
CLOSES = [{"li"}, {"dt", "dd"}, {"td", "th"}, {"tr"}, {"option"}, {"thead", "tbody", "tfoot"}]
SECTIONS = set("article main div section aside nav header footer form body figure table blockquote".split())
P_STAYS = INLINE | {"br", "button", "object", "iframe", "script", "style", "svg", "textarea", "select", "option"}

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|svg|math|textarea)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)|<[a-zA-Z/!?][^<>]*\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """An open element; its features are those of all its ancestors and its own."""

    __slots__ = ("tag", "features", "hidden", "score", "near")

    def __init__(self, tag: str, above: Node | None, attributes: str):
        self.tag = tag
        own = {"t:" + tag}
        if attributes:
            for m in ATTRIBUTE.finditer(attributes):
                own.update("c:" + w.lower().rstrip("s") for w in NAME.findall(html.unescape(m[2] or m[3] or m[4] or "")))
        self.features = (above.features | own) if above and not own <= above.features else above.features if above else frozenset(own)
        self.hidden = bool(above and above.hidden) or tag in HIDDEN
        self.near = tag if tag in SECTIONS or above is None else above.near
        self.score = None


def blocks(page: str) -> list[tuple[Node, str, float]]:
    """(parent, text, share of it inside links) of every leaf block with text, in page order."""
    root = Node("#", None, "")
    stack, out = [root], []
    parts: list[str] = []
    linked = total = links = at = 0

    def flush():
        nonlocal linked, total
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                top = next(n for n in reversed(stack) if n.tag not in INLINE)
                out.append((top, text, linked / max(1, total)))
            parts.clear()
            linked = total = 0

    def put(text):
        nonlocal linked, total
        if text and not stack[-1].hidden:
            parts.append(text)
            total += len(text)
            if links:
                linked += len(text)

    def drop(k):
        nonlocal links
        flush()
        for n in stack[k:]:
            links -= n.tag == "a"
            opened[n.tag] -= 1
        del stack[k:]

    opened: dict[str, int] = {}
    for m in PIECE.finditer(page):
        put(page[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            put(" ")
            continue
        if m[2]:  # an end tag
            if not opened.get(tag):
                if tag not in INLINE:
                    flush()
                continue
            k = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag)
            if tag not in INLINE or any(n.tag not in INLINE for n in stack[k + 1 :]):
                drop(k)
            else:
                for n in stack[k:]:
                    links -= n.tag == "a"
                    opened[n.tag] -= 1
                del stack[k:]
            continue
        if tag not in INLINE:
            flush()
            if opened.get("p") and tag not in P_STAYS:
                drop(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"))
            for group in CLOSES:
                if tag in group and stack[-1].tag in group:
                    drop(len(stack) - 1)
            if tag == "body" and opened.get("head"):
                drop(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "head"))
        if tag in VOID or m[4].endswith("/") and tag in INLINE:
            continue
        stack.append(Node(tag, stack[-1], m[4]))
        opened[tag] = opened.get(tag, 0) + 1
        links += tag == "a"
    put(page[at:])
    flush()
    return out


def text_features(node: Node, text: str, link: float, k: int, n: int) -> list[str]:
    words = text.count(" ") + 1
    return [
        "p:" + node.tag,
        "k:" + node.near,
        f"q:{node.tag}|{node.near}",
        f"n{min(7, words.bit_length())}",
        f"l{min(3, int(link * 3.5))}",
        "end" if text[-1] in ".!?…\"'”" else "open",
        f"s{min(3, text.count('. ') + text.count(', '))}",
        "sign" if "©" in text else "bare",
        "first" if k == 0 else "last" if k == n - 1 else "mid",
    ]


# --- labelled pages ------------------------------------------------------------------------------------------------

MARK = ""
#: Names that sites give to the parts of a page. Fixed values.
NOISE_NAMES = {
    "nav": "nav navbar menu navigation topnav mainmenu breadcrumb pagination pager toc",
    "header": "header masthead topbar siteheader logo branding tagline",
    "footer": "footer bottom copyright colophon legal sitefooter",
    "aside": "sidebar aside widget related recommended popular trending toplist archive tagcloud",
    "div": "ad ads advert advertisement sponsor sponsored promo banner cookie consent notice notification alert gdpr popup modal newsletter subscribe signup share social toolbar disclaimer warning",
    "section": "comment comments discussion responses replies reply disqus feedback reader readers",
    "form": "form search login contact subscribe poll survey",
}
NOISE_TAGS = {"nav": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"], "div": ["div", "section", "p", "aside"], "section": ["section", "section", "div", "ol", "ul", "aside"], "form": ["form"]}
BODY_NAMES = "content article post entry main story text body page container wrapper maincontent".split()


def labelled_pages(n: int, seed: int = 4) -> list[str]:
    """Pages whose article words begin with MARK."""
    rng = random.Random(seed)
    syllables = ["".join(rng.choice("bcdfghklmnprstvwz") + rng.choice("aeiouéü") for _ in range(1)) + rng.choice(["", "n", "r", "s"]) for _ in range(60)]

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def text(low, high, mark, stops=True):
        out = [word() for _ in range(rng.randint(low, high))]
        line = " ".join(w + ("." if stops and rng.random() < 0.12 else "," if stops and rng.random() < 0.08 else "") for w in out).capitalize()
        return (MARK if mark else "") + line + ("." if stops and rng.random() < 0.85 else "")

    def link(mark=False, low=1, high=3):
        return f'<a href="/{word()}">{text(low, high, mark, False)}</a>'

    def attribute(names):
        if rng.random() < 0.15:
            return ""
        name = rng.choice(names)
        if rng.random() < 0.3:
            name += rng.choice(["-", "_"]) + rng.choice(["box", "wrap", "inner", "list", "area", "1", "block", "item"])
        return f' {rng.choice(["class", "id"])}="{name}"'

    def noise(kind):
        names = NOISE_NAMES[kind].split()
        tag = rng.choice(NOISE_TAGS[kind])
        named = attribute(names)
        if not named and tag in ("div", "section", "p", "ul", "ol", "article"):
            named = f' class="{rng.choice(names)}"'
        if kind == "nav" or kind == "aside" and rng.random() < 0.6:
            inner = "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 8)))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>" if rng.random() < 0.8 else " | ".join(link() for _ in range(4))
            inner = (f"<h3>{text(1, 3, False, False)}</h3>" if kind == "aside" and tag != "ul" else "") + inner
        elif kind == "form":
            inner = f"<label>{text(1, 3, False, False)}</label><input type=text name=q><textarea>{text(1, 4, False)}</textarea><select><option>{word()}<option>{word()}</select><button>{word()}</button>" + (f"<p>{text(3, 15, False)}</p>" if rng.random() < 0.4 else "")
        elif kind == "section":
            item = lambda: f"<p>{text(3, 60, False)}</p>"
            inner = (f"<h3>{text(1, 3, False, False)}</h3>" if rng.random() < 0.6 else "") + "".join(f'<{("li" if tag in ("ul", "ol") else "div")}{attribute(["comment", "reply", "author", "response"])}><b>{word()}</b> {item()}</{("li" if tag in ("ul", "ol") else "div")}>' if rng.random() < 0.8 else item() for _ in range(rng.randint(1, 5)))
        elif kind == "footer":
            inner = rng.choice(["&copy; ", "© 2020 ", ""]) + f"{word()}.example &middot; {text(2, 20, False)}" + (f"<p>{link()} {link()}</p>" if rng.random() < 0.4 else "")
        elif kind == "header":
            inner = (f"<h1>{text(1, 4, False, False)}</h1>" if rng.random() < 0.5 else link()) + (f"<p>{text(2, 9, False)}</p>" if rng.random() < 0.6 else "")
        else:
            inner = text(2, 30, False) if rng.random() < 0.6 else f"<p>{text(2, 30, False)}</p><a href=/x>{word()}</a><button>{word()}</button>"
        close = "" if rng.random() < 0.03 else f"</{tag}>"
        role = f' role="{rng.choice(["navigation", "menu"])}"' if kind == "nav" and rng.random() < 0.2 else ""
        return f"<{tag}{named}{role}>{inner}{close}"

    def body_part():
        k = rng.random()
        if k < 0.62:
            inner = text(1, 90, True, rng.random() < 0.7) if rng.random() < 0.8 else text(3, 30, True) + f" <b>{word()}</b> " + text(2, 30, False)
            if rng.random() < 0.15:
                inner = f"<b>{inner}" + rng.choice(["</b>", "<br>", "<br/>"])
            if rng.random() < 0.12:
                inner += f" {link()} {text(1, 9, False)}"
            return f"<p>{inner}" + ("" if rng.random() < 0.15 else "</p>")
        if k < 0.75:
            return f"<h{(h := rng.randint(1, 4))}>{text(1, 10, True, rng.random() < 0.3)}</h{h}>"
        if k < 0.83:
            return "<ul>" + "".join(f"<li>{text(1, 14, True)}" + ("" if rng.random() < 0.3 else "</li>") for _ in range(rng.randint(2, 5))) + "</ul>"
        if k < 0.88:
            return f"<blockquote><p>{text(4, 40, True)}</p></blockquote>"
        if k < 0.92:
            return f"<table><tr><th>{text(1, 2, True, False)}<td>{text(1, 5, True)}</tr><tr><td>{text(1, 3, True)}</td><td>{text(1, 3, True)}</td></tr></table>"
        if k < 0.95:
            return f"<figure><img src=x><figcaption>{text(2, 12, True)}</figcaption></figure>"
        if k < 0.97:
            return f"<pre><code>{text(2, 20, True, False)}</code></pre>"
        return f"<div>{text(2, 40, True)}</div>"

    pages = []
    for _ in range(n):
        kinds = list(NOISE_NAMES)
        article = [f"<h1>{text(2, 10, True, rng.random() < 0.5)}</h1>"] if rng.random() < 0.7 else []
        article += [body_part() for _ in range(rng.randint(1, 12))]
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            article.insert(rng.randint(1, len(article)), noise(rng.choice(["div", "div", "aside", "form", "section"])))
        if rng.random() < 0.3:
            article.append(noise("section"))
        tag = rng.choice(["article"] * 6 + ["main", "main", "div", "div", "section", "td", ""])
        inner = "".join(article)
        if tag == "td":
            inner = f"<table><tr><td>{inner}</td></tr></table>"
        elif tag:
            named = attribute(BODY_NAMES) if rng.random() < 0.5 or tag in ("div", "section") else ""
            inner = f"<{tag}{named}>{inner}</{tag}>"
        if rng.random() < 0.4:
            inner = f"<div{attribute(BODY_NAMES)}>{inner}</div>"
        before = "".join(noise(rng.choice(["nav", "header", "div", "form", "aside"])) for _ in range(rng.randint(0, 3)))
        after = "".join(noise(rng.choice([*kinds, "footer", "section"])) for _ in range(rng.randint(0, 4)))
        pages.append(f"<!DOCTYPE html><html><head><title>{word()}</title><style>p{{}}</style></head><body>{before}{inner}{after}</body></html>")
    return pages


# --- the field -----------------------------------------------------------------------------------------------------


def train(pages: list[str]) -> dict:
    """Weights from marked pages, by gradient ascent on the conditional likelihood with a Gaussian prior."""
    names: dict[str, int] = {}
    rows, labels, lengths = [], [], []
    for page in pages:
        found = blocks(page)
        for k, (node, text, link) in enumerate(found):
            labels.append(int(MARK in text))
            plain = text.replace(MARK, "")
            features = [*node.features, *text_features(node, plain, link, k, len(found))]
            rows.append([names.setdefault(f, len(names)) for f in features])
        lengths.append(len(found))
    matrix = np.zeros((len(rows), len(names)), dtype=np.float32)
    for i, row in enumerate(rows):
        matrix[i, row] = 1
    n, longest = len(lengths), max(lengths)
    place = np.concatenate([np.arange(k) for k in lengths])
    page_of = np.repeat(np.arange(n), lengths)
    y = np.array(labels)
    last = np.array(lengths) - 1
    weights, moves = np.zeros(len(names), dtype=np.float64), np.zeros((2, 2))
    speed_w, speed_m = np.full(len(names), 1e-8), np.full((2, 2), 1e-8)
    same = np.flatnonzero((page_of[1:] == page_of[:-1]))
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[same], y[same + 1]), 1)
    for _ in range(STEPS):
        score = np.zeros((n, longest, 2))
        score[page_of, place, 1] = matrix @ weights.astype(np.float32)
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            ahead[:, t] = score[:, t] + np.logaddexp(ahead[:, t - 1, 0, None] + moves[0], ahead[:, t - 1, 1, None] + moves[1])
        for t in range(longest - 2, -1, -1):
            step = back[:, t + 1] + score[:, t + 1]
            full = np.logaddexp(moves[:, 0] + step[:, 0, None], moves[:, 1] + step[:, 1, None])
            back[:, t] = np.where((t < last)[:, None], full, 0)
        total = np.logaddexp(ahead[np.arange(n), last, 0], ahead[np.arange(n), last, 1])
        share = np.exp(ahead + back - total[:, None, None])[page_of, place, 1]
        grad_w = matrix.T @ (y - share).astype(np.float32) / n - DECAY * weights
        expected = np.zeros((2, 2))
        p, t = page_of[same], place[same]
        for a in (0, 1):
            for b in (0, 1):
                expected[a, b] = np.exp(ahead[p, t, a] + moves[a, b] + score[p, t + 1, b] + back[p, t + 1, b] - total[p]).sum()
        grad_m = (seen - expected) / n - DECAY * moves
        speed_w += grad_w**2
        speed_m += grad_m**2
        weights += RATE * grad_w / np.sqrt(speed_w)
        moves += RATE * grad_m / np.sqrt(speed_m)
    return {"weights": {f: float(weights[i]) for f, i in names.items()}, "moves": moves.tolist()}


def viterbi(scores: list[float], moves: list[list[float]]) -> list[int]:
    """The likeliest states, given each block's score for state 1."""
    (m00, m01), (m10, m11) = moves
    zero, one, back = 0.0, scores[0], []
    for s in scores[1:]:
        a, b = (zero + m00, one + m10), (zero + m01, one + m11)
        back.append((int(a[1] > a[0]), int(b[1] > b[0])))
        zero, one = max(a), max(b) + s
    state = int(one > zero)
    out = [state]
    for step in reversed(back):
        state = step[state]
        out.append(state)
    return out[::-1]


def main_text(page: str | None, model: dict) -> str:
    """The article's blocks, joined by one space."""
    found = blocks(page or "")
    if not found:
        return ""
    weights = model["weights"]
    scores = []
    for k, (node, text, link) in enumerate(found):
        if node.score is None:
            node.score = sum(weights.get(f, 0.0) for f in node.features)
        scores.append(node.score + sum(weights.get(f, 0.0) for f in text_features(node, text, link, k, len(found))))
    return " ".join(text for (_, text, _), state in zip(found, viterbi(scores, model["moves"])) if state)


def page_batches(batches, model):
    model = model.value
    for batch in small_batches(batches, "html", TEXT_BYTES):
        texts = [main_text(page, model) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("kept"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["key", "kept", "text", "n_chars"])


def extract(pages: DataFrame, key: str = "page_id", text: str = "html", keep: str = "url", model: dict | None = None) -> DataFrame:
    """(key, keep, text, n_chars): the main text of every page, and one string column of the table as it is.

    Whole pages are read. Character references are decoded, white space inside a block becomes one space, blocks are
    joined in page order by one space. The text is empty for null or empty pages and for pages without an article.
    Malformed markup is read as far as it goes: end tags without a start are passed over, open tags end with the page.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model or train(labelled_pages(PAGES)))
    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{keep}`").cast("string").alias("kept"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("html"))
    found = rows.mapInArrow(partial(page_batches, model=sent), f"key {kind}, kept string, text string, n_chars long")
    return found.toDF(key, keep, "text", "n_chars")
