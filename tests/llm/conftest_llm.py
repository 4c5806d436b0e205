"""Helpers of these tests."""

CLASHES = "digest keep_id node hashes size n rep comp hs shard bands label"


def collect(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


def brute_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def brute_shingles(text, width=5):
    w = brute_words(text)
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))}
