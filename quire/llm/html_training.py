"""Training of the block labeller on made-up pages; ``python -m quire.llm.html_training`` writes the weights anew.

Two pages in three name their parts, in the many ways in which pages do; the others have neutral names or none, so that
the model must tell comments, notices and legal lines by their words and by where containers end.
"""

from __future__ import annotations

import random
import re
import sys
from functools import cache

import numpy as np

from quire.llm.html import HIDDEN, WEIGHTS, Labeller, _sigmoid, blocks, padded, vectors

#: Names that pages give to the parts around and inside the main text.
ASIDES = "nav menu navbar navigation breadcrumb breadcrumbs header masthead banner footer copyright legal sidebar aside widget rail ad ads advert advertisement sponsored sponsor promo promotion notice cookie cookies consent gdpr alert popup modal newsletter subscribe signup form login search comment comments respond replies disqus related recommended share social tags toolbar pagination pager".split()
BODIES = "content main article post entry story body text page prose".split()
TAGS_OF = {"nav": ["nav"], "menu": ["nav"], "navigation": ["nav"], "header": ["header"], "masthead": ["header"], "footer": ["footer"], "copyright": ["footer"], "sidebar": ["aside"], "aside": ["aside"], "form": ["form"], "login": ["form"], "search": ["form"], "newsletter": ["form"], "comments": ["section"]}
#: What such parts say.
SAYINGS = {
    "comments": "Comments|Kommentare|Commentaires|Comentarios|Reply|Antworten|Répondre|Responder|says:|said|wrote:|posted|2 hours ago|yesterday at 10:31|Leave a comment|Log in to reply|3 likes|Show more replies".split("|"),
    "footer": "© 2024|Copyright 2023|All rights reserved.|Alle Rechte vorbehalten|Tous droits réservés|Todos los derechos reservados|Privacy policy|Terms of use|Impressum|Contact|Datenschutz|Mentions légales|Powered by".split("|"),
    "cookie": "We use cookies|This site uses cookies to improve your experience.|Accept all|Wir verwenden Cookies|Nous utilisons des cookies|Usamos cookies|Manage consent|By continuing you agree to our policy.".split("|"),
    "ad": "Advertisement|Sponsored|Anzeige|Publicité|Publicidad|Buy now|Limited offer|Shop now|Get 20% off|Free shipping".split("|"),
    "newsletter": "Subscribe to our newsletter|Enter your email|Sign up|Your name|Password|Log in|Search|Submit|Abonnieren|S'abonner|Suscribirse|Send".split("|"),
    "share": "Share this|Share on Facebook|Tweet|Follow us|Print|Email this|Tags:|Related articles|Read more|You may also like|Most popular|Teilen|Partager|Compartir".split("|"),
    "nav": "Home|News|About|Contact|Sport|Shop|Startseite|Accueil|Inicio|Next|Previous|Menu|Sign in|Skip to content|1|2|3|»".split("|"),
}
#: What readers say: in the first person, short.
REMARKS = "I|you|me|my|thanks|great|nice|post|agree|lol|like|this|love|it|really|wrong|so|not|sure|thank|merci|danke|gracias|toll|super|bravo|first|same|here|totally|what|why|bad|article|author|read|think|wonderful".split("|")
_SAYING_OF = {"comment": "comments", "respond": "comments", "replies": "comments", "disqus": "comments", "copyright": "footer", "legal": "footer", "cookies": "cookie", "consent": "cookie", "gdpr": "cookie", "notice": "cookie", "popup": "cookie", "alert": "cookie", "modal": "newsletter", "ads": "ad", "advert": "ad", "advertisement": "ad", "sponsored": "ad", "sponsor": "ad", "promo": "ad", "promotion": "ad", "banner": "ad", "subscribe": "newsletter", "signup": "newsletter", "form": "newsletter", "login": "newsletter", "search": "newsletter", "social": "share", "related": "share", "recommended": "share", "tags": "share", "sidebar": "share", "aside": "share", "widget": "share", "rail": "share"}


@cache
def _vocabulary() -> list[str]:
    parts = ["er", "th", "in", "ou", "la", "de", "ch", "pa", "ti", "on", "ung", "ci", "es", "re", "st", "ve", "mo", "qu", "é", "ción", "keit", "ü", "ße"]
    rng = random.Random(1)
    return ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(3000)]


def made_up_page(rng: random.Random) -> list[tuple[str, bool]]:
    """Markup of a page in pieces, with whether the text of each piece is main text."""
    words, chance, pick = _vocabulary(), rng.random, rng.choice
    word = lambda: pick(words)
    neutral = chance() < 0.35
    marks = {"prefix": pick(["x", "b", "c-", "el", "css-", "s", "_", "u"]), "n": rng.randint(1, 400)}

    def attribute(names: list[str]) -> str:
        if not neutral:
            return f' {pick(["class", "id"])}="{pick(names)}"'
        if chance() < 0.3:
            return ""
        marks["n"] += rng.randint(1, 9)
        return f' {pick(["class", "id"])}="{marks["prefix"]}{marks["n"]}"'

    def sentence(least: int, most: int) -> str:
        text = " ".join(rng.choices(words, k=rng.randint(least, most)) if chance() < 0.95 else [word()] * rng.randint(least, most))
        return text.capitalize() + (". " if chance() < 0.8 else " ") + (f"&amp; {word()}" if chance() < 0.1 else "") + (f" {rng.randint(1, 2030)} " if chance() < 0.1 else "")

    def remark() -> str:
        own = [pick(REMARKS) if chance() < 0.55 else word() for _ in range(rng.randint(2, 25))]
        return " ".join(own).capitalize() + pick([".", "!", "", "?", "..."])

    def comments() -> list[tuple[str, bool]]:
        out, inner, named = [], pick(["div", "li", "article" if chance() < 0.15 and not neutral else "div", "p"]), chance() < 0.7
        if chance() < 0.6:
            out.append((f"<h{rng.randint(2, 4)}>{pick(['', '3 ', '12 '])}{pick(SAYINGS['comments'][:4])}</h3>", False))
        for _ in range(rng.randint(1, 6)):
            who = f"{pick(['<b>', '<span>', '<cite>'])}{word().capitalize()} {pick(SAYINGS['comments'][4:13]) if chance() < 0.7 else ''}</b> " if named else ""
            said = remark() if chance() < 0.8 else sentence(3, 30)
            out.append((f"<{inner}>{who}{said}</{inner}>" if inner == "p" or chance() < 0.5 else f"<{inner}{attribute(['comment', 'reply', 'comment-body', word()])}><p>{who}</p><p>{said}</p></{inner}>", False))
        return out

    def aside(name: str) -> list[tuple[str, bool]]:
        tag = "div" if neutral and chance() < 0.8 else pick(TAGS_OF.get(name, ["div", "section"]) if chance() < 0.6 else ["div", "section", "aside"])
        plain = tag in ("nav", "header", "footer", "aside", "form") and chance() < 0.6
        kind = _SAYING_OF.get(name, name if name in SAYINGS else "nav")
        sayings = SAYINGS[kind]
        out = [(f"<{tag}{'' if plain else attribute([name, name, f'{name}-box', f'site-{name}', f'{name} {word()}'])}>", False)]
        if kind == "comments":
            return [*out, *comments(), (f"</{tag}>", False)]
        telling = 0.85 if neutral else 0.4
        for _ in range(rng.randint(1, 4)):
            part = chance()
            say = lambda: pick(sayings) if chance() < telling else word()
            if part < 0.3 or (kind == "nav" and part < 0.8):
                link = pick(["<li>{}</li>", "<li>{}</li>", "{} ", "<span>{}</span> | "])
                items = "".join(link.format(f'<a href="/{word()}">{say()}</a>') for _ in range(rng.randint(1, 7)))
                out.append((f"<ul>{items}</ul>" if link.startswith("<li") else items, False))
            elif kind == "newsletter" and part < 0.7:
                out.append((f"<label>{say()}</label><input name=q><button>{say()}</button>", False))
            elif part < 0.6:
                out.append((f"<p>{say() + ' ' if neutral or chance() < 0.5 else ''}{sentence(3, 40) if not neutral or chance() < 0.5 else say()}</p>", False))
            elif part < 0.7:
                out.append((f"<h{rng.randint(1, 4)}>{say()} {sentence(1, 5) if chance() < 0.5 else ''}</h3>", False))
            else:
                out.append((("&copy; " if kind == "footer" and chance() < 0.7 else "") + say() + " " + (sentence(2, 30) if chance() < 0.6 else ""), False))
        return [*out, (f"</{tag}>", False)]

    out = [(f"<html><head><title>{sentence(2, 9)}</title></head><body>", False)]
    wraps = rng.randint(0, 3) if chance() < 0.4 else 0
    out += [(f"<div{attribute(['wrap', 'container', 'page', 'row', word()])}>", False)] * wraps
    for name in [*(["nav"] if chance() < 0.6 else []), *(["header"] if chance() < 0.4 else []), *(pick(ASIDES) for _ in range(rng.randint(0, 2)))]:
        out += aside(name)
    shell = pick(["div", "div", "div", "main", "article", "section"] if neutral else ["article", "article", "main", "div", "div", "section"])
    bare = shell in ("article", "main") and chance() < 0.6
    out.append((f"<{shell}>" if bare else f"<{shell}{attribute([f'{b}{e}' for b in BODIES for e in ('', '-body', ' wide')])}>", False))
    if chance() < 0.8:
        out.append((f"<h1>{sentence(1, 12)}</h1>", True))
    if chance() < 0.1:  # a line that an article repeats, refrains and list-like texts among them
        line, around = sentence(1, pick([4, 12, 25])), pick([("<p>", "</p>"), ("<p>", "</p>"), ("<div>", "</div>"), ("<p>", "")])
        out += [(f"{around[0]}{line if chance() < 0.9 else sentence(1, 12)}{around[1]}", True) for _ in range(rng.randint(3, pick([8, 20, 60])))]
    long = chance() < 0.06
    for _ in range(rng.randint(1, 80 if long else 9)):
        kind = chance()
        if kind < 0.1:
            out.append((f"<h{rng.randint(2, 4)}>{sentence(1, 7)}</h2>", True))
        elif kind < 0.2:
            out.append(("<ul>" + "".join(f"<li>{sentence(1, 12)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>", True))
        elif kind < 0.25:
            out.append((f"<blockquote>{sentence(3, 30)}</blockquote>", True))
        elif kind < 0.3:
            out.append((f"<table><tr><td>{sentence(1, 5)}</td><td>{sentence(1, 5)}</td></tr></table>", True))
        elif kind < (0.31 if long else 0.38):
            out += aside(pick(["ad", "share", "related", "promo", "advert", "sponsored", "notice", "form", "newsletter", "comments"]))
        else:
            opened, closed = pick([("<p>", "</p>"), ("<p>", "</p>"), ("<p><b>", "<br>"), ("<p>", ""), ("<div>", "</div>")])
            link = f'<a href="/x">{word()} {word()}</a> {sentence(1, 9)}' if chance() < 0.2 else ""
            out.append((f"{opened}{sentence(1, 6 if long else 60)}{link}{closed}", True))
    out.append((f"</{shell}>", False))
    for name in [*(pick(ASIDES) for _ in range(rng.randint(0, 2))), *(["comments"] if chance() < 0.4 else []), *(["footer"] if chance() < 0.7 else [])]:
        out += aside(name)
    return [*out, *[("</div>", False)] * wraps, ("</body></html>", False)]


def labelled(rng: random.Random) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of a made-up page's blocks, and their labels; a private mark in each piece tells where its blocks end up."""
    pieces = made_up_page(rng)
    marked = "".join(re.sub(r">(?=[^<])|^(?=[^<])", lambda m: m[0] + "\x01", text) if main else text for text, main in pieces)
    found = blocks(marked)
    y = np.array(["\x01" in b.text for b in found], dtype=np.float32)
    for b in found:
        b.text = b.text.replace("\x01", "").strip() or "."
    return vectors(found), y


def gradients(model: Labeller, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Derivatives of the mean cross-entropy of the blocks under ``mask`` by the model's weights."""
    w, traces = model.weights, {"f": [], "b": []}
    both = np.concatenate([model.run(x, mask, d, traces[d]) for d in "fb"] + [x], axis=2)
    off = (_sigmoid((both @ w["o"])[..., 0] + w["p"]) - y) * mask / mask.sum()
    grad = {"o": np.einsum("btk,bt->k", both, off)[:, None], "p": np.array([off.sum()])}
    for n, d in enumerate("fb"):
        above = off[..., None] * w["o"][n * HIDDEN : (n + 1) * HIDDEN, 0]
        dh = dc = np.zeros((len(x), HIDDEN), dtype=np.float32)
        gx, gh, gc = np.zeros_like(w[f"x{d}"]), np.zeros_like(w[f"h{d}"]), np.zeros_like(w[f"c{d}"])
        for t, i, f, o, g, c, h, shown, m in reversed(traces[d]):
            dh = dh + above[:, t]
            live, keep = dh * m, dh * ~m
            inner = dc * m + live * o * (1 - shown**2)
            dz = np.concatenate([inner * g * i * (1 - i), inner * c * f * (1 - f), live * shown * o * (1 - o), inner * i * (1 - g**2)], axis=1)
            gx += x[:, t].T @ dz
            gh += h.T @ dz
            gc += dz.sum(axis=0)
            dh, dc = dz @ w[f"h{d}"].T + keep, inner * f + dc * ~m
        grad |= {f"x{d}": gx, f"h{d}": gh, f"c{d}": gc}
    return grad


def train(seed: int = 7, rounds: int = 1600, batch: int = 32) -> Labeller:
    """A model trained on ``rounds * batch`` made-up pages by Adam."""
    rng, model = random.Random(seed), Labeller(seed)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for n in range(1, rounds + 1):
        pages = [labelled(rng) for _ in range(batch)]
        x, mask = padded([p for p, _ in pages])
        y = np.zeros(mask.shape, dtype=np.float32)
        for k, (_, own) in enumerate(pages):
            y[k, : len(own)] = own
        rate = 0.01 * (1 - n / (rounds + 1)) + 0.0002
        for k, g in gradients(model, x, mask, y).items():
            g = np.clip(g, -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            model.weights[k] -= (rate * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.999**n)) + 1e-8)).astype(np.float32)
    return model


def accuracy(model: Labeller, seed: int = 99, pages: int = 200) -> float:
    """Share of the blocks of other made-up pages that are labelled rightly."""
    rng, right, total = random.Random(seed), 0, 0
    for _ in range(pages):
        x, y = labelled(rng)
        right += int(((model.scores(*padded([x]))[0] >= 0.5) == (y > 0.5)).sum())
        total += len(y)
    return right / total


def main() -> None:
    model = train(rounds=int(sys.argv[1]) if sys.argv[1:] else 1600)
    np.savez_compressed(WEIGHTS, **{k: v.astype(np.float16) for k, v in model.weights.items()})
    print(f"{accuracy(model):.4f} of held-out blocks right")


if __name__ == "__main__":
    main()
