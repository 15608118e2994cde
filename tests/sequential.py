"""Plain one-at-a-time forms of what the engine does in parallel."""

from collections import Counter


def merge_once(ids, left, right, made):
    out, i = [], 0
    while i < len(ids):
        if i + 1 < len(ids) and (ids[i], ids[i + 1]) == (left, right):
            out.append(made)
            i += 2
        else:
            out.append(ids[i])
            i += 1
    return out


def count(states):
    pairs = Counter()
    for ids, freq in states:
        for pair in zip(ids, ids[1:]):
            pairs[pair] += freq
    return pairs


def train(freqs, merges):
    """``[(left, right, count)]`` of a trainer that makes one merge at a time."""
    states = [(list(chunk.encode()), freq) for chunk, freq in freqs.items()]
    made = []
    while len(made) < merges:
        pairs = count(states)
        if not pairs:
            break
        (left, right), freq = min(pairs.items(), key=lambda item: (-item[1], item[0]))
        states = [(merge_once(ids, left, right, 256 + len(made)), n) for ids, n in states]
        made.append((left, right, freq))
    return made


def windows(tokens, block, stride, eos=None):
    out = []
    for start in range(0, len(tokens) - block, stride):
        x, y = tokens[start : start + block], tokens[start + 1 : start + block + 1]
        if eos is not None and eos in x:
            at = x.index(eos)
            y = y[:at] + [-100] * (block - at)
        out.append((x, y))
    return out
