"""Main text of pages by a linear-chain conditional random field.

The leaf blocks of a page (``html_blocks``) are a chain; each gets features of
the elements around it (tags, words of classes, ids and roles) and of its
text, and the two labels "article" and "rest" have learned feature weights and
transitions.  The field is trained by stochastic gradient ascent of the
likelihood (forward-backward) on labelled pages, which ``labelled_pages``
makes from a page grammar of many layouts, and pages are decoded by Viterbi.
The model is a few thousand numbers and is broadcast.

Defined cases: a null or empty page gives an empty text, as does a page without
article blocks; broken and cut-off markup is read as far as it goes; pages of
any length are read whole; repeated rows are extracted each by itself; other
columns are ignored.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import text_slices
from parcelkit.llm.html_blocks import Block, blocks

FEATURES = 1 << 13
TRAIN_PAGES, EPOCHS, RATE, SEED = 800, 5, 0.15, 5


@lru_cache(maxsize=100_000)
def _feature(name: str) -> int:
    return zlib.crc32(name.encode("utf-8")) % FEATURES


def features(chain: list[Block]) -> list[list[int]]:
    """Feature numbers of each block."""
    out = []
    for k, b in enumerate(chain):
        words = b.text.count(" ") + 1
        letters = sum(map(str.isalpha, b.text)) / len(b.text)
        names = [f"around {a}" for a in b.around]
        names += [f"inner {b.inner}", f"depth {min(b.depth, 9)}", f"words {min(words, 256).bit_length()}",
                  f"links {4 * b.link_chars // len(b.text)}", f"letters {int(4 * letters)}",
                  f"ends {b.text[-1] if b.text[-1] in '.!?:;,' else 'other'}",
                  f"inner {b.inner} links {2 * b.link_chars // len(b.text)}",
                  f"inner {b.inner} words {min(words, 64).bit_length() // 2}"]
        if "\N{COPYRIGHT SIGN}" in b.text:
            names.append("copyright")
        if k == 0:
            names.append("first")
        out.append([_feature(x) for x in names])
    return out


@dataclass
class Crf:
    """Weights of "article" against "rest", and of each label after each other."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    follow: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def emissions(self, chain: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[f].sum() for f in chain])

    def viterbi(self, chain: list[list[int]]) -> list[int]:
        """The likeliest labels of the whole chain."""
        if not chain:
            return []
        (f00, f01), (f10, f11) = self.follow.tolist()
        scores = self.emissions(chain).tolist()
        rest, article, back = 0.0, scores[0], []
        for e in scores[1:]:
            to_rest, to_article = article + f10 > rest + f00, article + f11 >= rest + f01
            back.append((int(to_rest), int(to_article)))
            rest, article = (article + f10 if to_rest else rest + f00,
                             e + (article + f11 if to_article else rest + f01))
        labels = [int(article > rest)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def marginals(self, chain: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """(probability of "article" of each block, expected counts of each label pair)."""
        scores = np.stack([np.zeros(len(chain)), self.emissions(chain)], 1)
        n = len(chain)
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        forward[0] = scores[0]
        for t in range(1, n):
            forward[t] = scores[t] + np.logaddexp(forward[t - 1, 0] + self.follow[0], forward[t - 1, 1] + self.follow[1])
        for t in range(n - 2, -1, -1):
            ahead = scores[t + 1] + backward[t + 1]
            backward[t] = np.logaddexp(self.follow[:, 0] + ahead[0], self.follow[:, 1] + ahead[1])
        total = np.logaddexp(*forward[-1])
        single = np.exp(forward[:, 1] + backward[:, 1] - total)
        pairs = np.exp(forward[:-1, :, None] + self.follow + (scores[1:] + backward[1:])[:, None, :] - total).sum(0)
        return single, pairs


def train(chains: list[tuple[list[list[int]], list[int]]], epochs: int = EPOCHS, rate: float = RATE,
          seed: int = SEED) -> Crf:
    """Stochastic gradient ascent of the conditional likelihood, one page a step."""
    crf, rng = Crf(), np.random.default_rng(seed)
    steps, step = epochs * max(1, len(chains)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(chains)):
            chain, labels = chains[i]
            lr = rate * (1 - step / steps)
            step += 1
            if not chain:
                continue
            single, pairs = crf.marginals(chain)
            crf.weights *= 1 - lr * 1e-4
            for f, y, p in zip(chain, labels, single.tolist(), strict=True):
                np.add.at(crf.weights, f, lr * (y - p))
            seen = np.zeros((2, 2))
            np.add.at(seen, (labels[:-1], labels[1:]), 1)
            crf.follow += lr * 0.2 * (seen - pairs)
    return crf


# -- labelled pages -------------------------------------------------------


class _Grammar:
    """Random pages of many layouts whose blocks are known to be article or rest."""

    def __init__(self, rng: random.Random):
        self.rng, self.article = rng, set()
        letters = rng.choice(["aeioutnrsldm", "aeiouéèànrstlpm", "aeioäöüßnrstchg", "aeiouñóínrsdlc", "аеионтрслкм"])
        self.vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(400)]

    def words(self, low: int, high: int) -> str:
        return " ".join(self.rng.choice(self.vocabulary) for _ in range(self.rng.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join((self.words(1, 22)).capitalize() + self.rng.choice("....!?") for _ in range(self.rng.randint(low, high)))

    def noise(self, text: str) -> str:
        if self.rng.random() < 0.1:
            text = " ".join(w + self.rng.choice(["***", "###", "%%%", "!!", "$$$", " |"]) for w in text.split())
        return text

    def mine(self, text: str) -> str:
        """An article block's text, remembered as such."""
        text = self.noise(text)
        self.article.add(text)
        if self.rng.random() < 0.2:
            words = text.split(" ")
            k = self.rng.randrange(len(words))
            words[k] = self.rng.choice(["<b>{}</b>", "<em>{}</em>", '<a href="/x">{}</a>', "<span>{}</span>"]).format(words[k])
            text = " ".join(words)
        return text

    def named(self, names: list[str]) -> str:
        name, extra = self.rng.choice(names), self.rng.choice(["", "-box", " wrap", "-1", "_inner"])
        return f' {self.rng.choice(["class", "class", "id"])}="{name}{extra}"'

    def element(self, tags: list[str], names: list[str], body: str) -> str:
        tag = self.rng.choice(tags)
        if tag == "p" and ("<p" in body or "<h" in body):
            tag = "div"      # a paragraph holds no paragraphs
        named = self.named(names) if tag in ("div", "section", "ul", "p", "span", "td") or self.rng.random() < 0.4 else ""
        return f"<{tag}{named}>{body}</{tag}>"

    def menu(self) -> str:
        items = "".join(f'<li><a href="/{i}">{self.words(1, 3)}</a></li>' for i in range(self.rng.randint(3, 9)))
        return self.element(["nav", "nav", "div", "ul", "header"], ["menu", "nav", "navbar", "breadcrumb", "topnav", "navigation"],
                            f"<ul>{items}</ul>")

    def header(self) -> str:
        body = f"<div><a href='/'>{self.words(1, 4)}</a></div><p>{self.sentences(1, 1)}</p>"
        return self.element(["header", "div"], ["header", "masthead", "site-header", "top", "logo", "branding"], body)

    def footer(self) -> str:
        body = self.rng.choice(["&copy; {} &middot; {}", "<p>&copy; {}</p><p>{}</p>", "<p>{}</p><ul><li><a href='/p'>{}</a></li></ul>"])
        return self.element(["footer", "footer", "div"], ["footer", "site-footer", "bottom", "copyright", "legal"],
                            body.format(self.words(1, 4), self.sentences(1, 3)))

    def advert(self) -> str:
        body = self.rng.choice(["{}", "<p>{}</p>", '<a href="/buy">{}</a>', "<h3>{}</h3>"])
        return self.element(["div", "div", "aside", "section", "p"], ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "sponsor",
                                                              "banner", "adsense"], body.format(self.sentences(1, 5)))

    def notice(self) -> str:
        return self.element(["div", "section", "p", "dialog"], ["cookie", "cookies", "consent", "notice", "gdpr", "alert", "newsletter",
                                                      "popup", "modal", "subscribe", "paywall", "overlay"],
                            self.rng.choice(["{}", "<p>{}</p><button>ok</button>"]).format(self.sentences(1, 4)))

    def side(self) -> str:
        items = "".join(f"<li><a href='/r{i}'>{self.words(2, 8)}</a></li>" for i in range(self.rng.randint(2, 6)))
        body = self.rng.choice([f"<h3>{self.words(1, 3)}</h3><ul>{items}</ul>", f"<p>{self.sentences(1, 4)}</p>", f"<ul>{items}</ul>"])
        return self.element(["aside", "aside", "div", "section"], ["sidebar", "side", "related", "widget", "share", "social", "tags", "recommended",
                                                 "popular", "rail", "secondary", "toc"], body)

    def form(self) -> str:
        return (f'<form action="/s"><label>{self.words(1, 3)}</label><input name="q"><select><option>{self.words(1, 2)}'
                f"<option>{self.words(1, 2)}</select><p>{self.sentences(1, 2)}</p><textarea>{self.words(2, 6)}</textarea>"
                f"<button>{self.words(1, 2)}</button></form>")

    def comments(self) -> str:
        rows = "".join(self.rng.choice(["<div class='comment'><b>{}</b><p>{}</p></div>", "<li class='comment'><cite>{}</cite> {}</li>",
                                        "<article class='comment'><h4>{}</h4><p>{}</p></article>"])
                       .format(self.words(1, 2), self.sentences(1, 5)) for _ in range(self.rng.randint(1, 5)))
        return self.element(["section", "div", "div"], ["comments", "comment-list", "responses", "discussion", "replies", "disqus"],
                            self.rng.choice(["", f"<h3>{self.words(1, 3)}</h3>"]) + rows)

    def paragraph(self) -> str:
        kind = self.rng.random()
        if kind < 0.72:
            text = self.mine(self.sentences(1, self.rng.choice([1, 2, 6])))
            return self.rng.choice(["<p>{}</p>"] * 6 + ["<p>{}\n", "<p><b>{}<br>", "<div>{}</div>"]).format(text)
        if kind < 0.8:
            return f"<{(h := self.rng.choice(['h2', 'h3', 'h4']))}>{self.mine(self.words(1, 8))}</{h}>"
        if kind < 0.88:
            tag = self.rng.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{self.mine(self.words(1, 20))}</li>" for _ in range(self.rng.randint(1, 5))) + f"</{tag}>"
        if kind < 0.94:
            return f"<blockquote><p>{self.mine(self.sentences(1, 3))}</p></blockquote>"
        if kind < 0.97:
            rows = "".join(f"<tr><td>{self.mine(self.words(1, 4))}</td><td>{self.mine(self.words(1, 4))}</td></tr>" for _ in range(3))
            return f"<table>{rows}</table>"
        return f"<pre>{self.mine(self.words(2, 12))}</pre>"

    def main(self) -> str:
        title = f"<h1>{self.mine(self.words(1, 14))}</h1>"
        if self.rng.random() < 0.1:
            title = f"<header>{title}</header>"
        body = [self.paragraph() for _ in range(self.rng.choice([1, 2, 4, 8, 15]))]
        for extra in (self.advert, self.side, self.notice, self.form, self.menu):
            if self.rng.random() < 0.12:
                body.insert(self.rng.randrange(len(body) + 1), extra())
        if self.rng.random() < 0.1:
            body.append(self.comments())
        inner = title + self.rng.choice(["", "\n"]).join(body)
        if self.rng.random() < 0.2:
            inner = f"<div{self.named(['body', 'text', 'content', 'entry'])}>{inner}</div>"
        kind = self.rng.random()
        if kind < 0.5:
            return f"<article>{inner}</article>"
        if kind < 0.7:
            return f"<main>{self.rng.choice(['{}', '<article>{}</article>']).format(inner)}</main>"
        if kind < 0.95:
            return f"<div{self.named(['content', 'article', 'post', 'entry', 'story', 'main', 'text', 'page'])}>{inner}</div>"
        return f"<div>{inner}</div>"

    def page(self) -> str:
        rng = self.rng
        some = lambda part, p: part() if rng.random() < p else ""
        parts = [some(self.notice, 0.3), some(self.header, 0.4), some(self.menu, 0.8), some(self.advert, 0.6), some(self.form, 0.2),
                 some(self.side, 0.2), self.main(), some(self.side, 0.4), some(self.advert, 0.2), some(self.comments, 0.4),
                 some(self.form, 0.15), some(self.footer, 0.9), some(self.notice, 0.15)]
        head = f"<head><title>{self.words(2, 9)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
        end = rng.choice(["</body></html>", "</body></html>", ""])
        wrap = rng.choice(["{}", "{}", "<div id='page'>{}</div>", "<div class='container'><div class='row'>{}</div></div>"])
        return f"<!DOCTYPE html><html>{head}<body>{wrap.format(rng.choice(['', '<!-- x -->']).join(parts))}{end}"


def labelled_pages(count: int = TRAIN_PAGES, seed: int = SEED) -> list[tuple[str, set[str]]]:
    """(html, texts of its article blocks) by a seeded grammar."""
    rng, out = random.Random(seed), []
    for _ in range(count):
        grammar = _Grammar(rng)
        out.append((grammar.page(), grammar.article))
    return out


def labelled_chains(pages: list[tuple[str, set[str]]]) -> list[tuple[list[list[int]], list[int]]]:
    out = []
    for page, article in pages:
        chain = blocks(page)
        out.append((features(chain), [int(b.text in article) for b in chain]))
    return out


@lru_cache(maxsize=1)
def default_model() -> Crf:
    return train(labelled_chains(labelled_pages()))


def main_text(page: str | None, crf: Crf) -> str:
    """Texts of the article blocks in page order, joined by a space."""
    chain = blocks(page)
    return " ".join([b.text for b, y in zip(chain, crf.viterbi(features(chain)), strict=True) if y])


def extract_pages(pages: DataFrame, model: Crf | None = None, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page; one narrow pass without a shuffle."""
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())
    id_type = pages.schema[id_col].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        for part in text_slices(batches, "html"):
            texts = [main_text(h, crf) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return (rows.mapInArrow(extract, f"id {id_type}, url string, text string, n_chars bigint")
            .withColumnsRenamed({"id": id_col, "url": url_col}))
