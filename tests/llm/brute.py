"""Brute-force versions of the operators, in plain Python."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


class Sets:
    """Union-find with the smallest member as root."""

    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
