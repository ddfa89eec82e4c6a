"""Page elements by the standard library's parser: what the column expressions are held against."""

from html.parser import HTMLParser

from claimrisk.functions.html import KINDS, SILENT, WHOLE


class _Elements(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.text, self.kind, self.whole, self.silent = [], [], "text", [], 0

    def cut(self):
        content = " ".join("".join(self.text).split())
        if content:
            self.found.append((self.kind, content))
        self.text, self.kind = [], "text"

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent += 1
        elif self.whole:
            if tag == self.whole[0]:
                self.whole.append(tag)
            spans = "".join(f" {k}={v}" for k, v in sorted(attrs) if k in ("colspan", "rowspan"))
            self.text.append(f"<{tag}{spans}>" if self.kind == "table" and tag in ("tr", "td", "th") else " ")
        elif tag in KINDS:
            self.cut()
            self.kind = KINDS[tag]
            if tag in WHOLE:
                self.whole = [tag]
        elif tag == "br":
            self.text.append(" ")

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif self.whole:
            if self.kind == "table" and tag in ("tr", "td", "th"):
                self.text.append(f"</{tag}>")
            if tag == self.whole[0]:
                self.whole.pop()
                if not self.whole:
                    self.cut()
        elif tag in KINDS:
            self.cut()

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)


def parse(html):
    parser = _Elements()
    parser.feed(html or "")
    parser.close()
    parser.cut()
    return parser.found
