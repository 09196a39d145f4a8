"""A plain extractor over the standard library's HTML parser, for well-formed pages; shares no code with the operator."""

from collections import defaultdict
from html.parser import HTMLParser

SKIP = {"script", "style", "nav", "footer", "aside", "form", "head", "button", "select", "textarea", "noscript", "title", "dialog", "menu"}
INLINE = {"a", "b", "i", "em", "strong", "span", "u", "small", "code", "sub", "sup", "img", "math", "mi", "mo", "object", "td", "th", "label"}
EMPTY = {"br", "hr", "img", "input", "meta", "link"}
ASIDE_CLASSES = {"ad", "comments", "sidebar", "cookie-notice", "related-posts", "comments-area", "social-share"}


class Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks, self.text = [], [], ""

    def part(self):
        if any(out for _, out in self.open):
            return "out"
        return "main" if any(tag in ("article", "main") for tag, _ in self.open) else "open"

    def flush(self):
        text = " ".join(self.text.split())
        if text:
            self.blocks.append((self.part(), text))
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
        elif tag in ("td", "th"):
            self.text += " "
        if tag in EMPTY:
            return
        named = tag == "div" and set((dict(attrs).get("class") or "").split()) & ASIDE_CLASSES
        self.open.append((tag, tag in SKIP or bool(named) or (tag == "header" and self.part() != "main")))

    def handle_endtag(self, tag):
        if tag in [t for t, _ in self.open]:
            if tag not in INLINE:
                self.flush()
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        self.text += data


def read(page):
    r = Reader()
    r.feed(page or "")
    r.close()
    r.flush()
    return tuple((p, t) for p, t in r.blocks if p != "out")


def texts(pages, run=8):
    """Main text of every page of one host."""
    found = [read(p) for p in pages]
    distinct = set(found)
    holders = defaultdict(set)
    for page in distinct:
        words = [w for _, t in page for w in t.split(" ")]
        for i in range(len(words) - run + 1):
            holders[tuple(words[i:i + run])].add(page)

    def under(page, least):
        words = [w for _, t in page for w in t.split(" ")]
        hit = set()
        for i in range(len(words) - run + 1):
            if len(holders[tuple(words[i:i + run])]) >= least:
                hit |= set(range(i, i + run))
        return hit

    def text(page):
        template, always = under(page, max(3, 0.2 * len(distinct))), under(page, max(8, 0.8 * len(distinct)))
        main, open_, at = [], [], 0
        for part, t in page:
            words = t.split(" ")
            here = range(at, at + len(words))
            at += len(words)
            main.append(t if part == "main" and not set(here) <= always else "")
            keep = []
            if part == "open" and not set(here) <= template:
                k = 0
                while k < len(words):
                    end = k
                    while end < len(words) and here[end] in template:
                        end += 1
                    keep += words[k:end] if end - k < run else []
                    if end == k:
                        keep.append(words[k])
                        end += 1
                    k = end
            open_.append(" ".join(keep))
        beside = not any(p == "main" for p, _ in page) or sum(map(len, open_)) > sum(map(len, main))
        return "\n".join(x for m, o in zip(main, open_) for x in (m, o if beside else "") if x)

    return [text(p) for p in found]
