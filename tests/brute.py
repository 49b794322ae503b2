"""Plain Python that tests compare with."""

import hashlib
import html
import re
import string
import unicodedata
from collections import defaultdict

import numpy as np
from corpusloom.functions import cleaning
from corpusloom.operators import lsh


def restated(text: str, intended: bool = False) -> str:
    """The cleaning chain step by step."""
    for a, b in cleaning.MARKUP:
        text = text.replace(a, b)
    text = html.unescape(text)
    text = re.sub(r"[\r\n\t]+", " " if intended else ".", text)
    text = "".join(ch for ch in text if not unicodedata.category(ch).startswith("C"))
    if intended:
        text = "".join(ch for ch in text if unicodedata.category(ch) != "So")
    text = text.translate(str.maketrans(cleaning.PUNCTUATION_FROM, cleaning.PUNCTUATION_TO))
    text = re.sub(f"[^{cleaning.KEPT}]", " ", text)
    text = re.sub(cleaning.NEWS_TAGS, "", text)
    text = re.sub(cleaning.URL, "", re.sub(cleaning.ANCHORS, "", text))
    if "@" in text:
        text = re.sub(r"(^|[^@\w])@(\w{1,15})\b", r"\1" if intended else "", text.replace("@<user>", ""))
        text = text if intended else " ".join("".join(text.split()))
    text = re.sub(r"\b(\w+)( \1\b)+", r"\1", text)
    for p in string.punctuation:
        text = re.sub(f"{re.escape(p)}+", lambda m: m[0][0], text)
    return " ".join(text.split())


def sequential(tokens, pairs, threshold):
    """Clusters by inserting documents one by one."""
    clusters = {}
    for i in sorted(tokens):
        near = sorted(a for a, b in pairs if b == i)
        for a in near:
            if a in clusters:
                clusters[a].append(i)
                break
        else:
            if near:
                clusters[near[0]] = [near[0], i]
    out = set()
    for base, members in clusters.items():
        extremes = {}
        for i in members:
            for x in extremes:
                if len(tokens[x] & tokens[i]) / len(tokens[x] | tokens[i]) >= threshold:
                    extremes[x] += 1
                    break
            else:
                extremes[i] = 1
        out |= {(base, i, i in extremes, extremes.get(i)) for i in members}
    return out


def brute_pairs(tokens, counts, config):
    """All pairs (a, b), a < b, that share a band, by plain arithmetic."""
    buckets = defaultdict(set)
    for i, words in tokens.items():
        if counts[i] >= config.min_tokens and words:
            h = np.array([int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in words], dtype=object)
            slots = [int(min((m * h + c) % lsh.PRIME)) for m, c in map(lsh.permutation, range(config.slots))]
            for band in range(config.bands):
                buckets[band, *slots[band * config.rows : (band + 1) * config.rows]].add(i)
    return {(a, b) for ids in buckets.values() for a in ids for b in ids if a < b}
