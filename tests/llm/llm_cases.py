"""Cases and brute force that several tests share."""

import numpy as np

#: Null and empty texts, ties, repeated rows, a null id, and columns whose names clash.
ODD = [(5, "same text here. It is short.\nAnd a line", "x"), (1, None, "x"), (2, "", None),
       (5, "same text here. It is short.\nAnd a line", "x"), (None, "no id", "y"), (9, "a" * 3000, "z"),
       (7, "word " * 2000, "z"), (3, "é😀ß \n  \t it's '' 've 12½", None)]


def repeated_bytes(docs, length):
    """Bytes to remove per (id, text), by a table of all windows."""
    least = {}
    for i, t in docs:
        if i is not None:
            for j in range(len(t) - length + 1):
                least[t[j:j + length]] = min(i, least.get(t[j:j + length], i))
    out = []
    for i, t in docs:
        gone = np.zeros(len(t), bool)
        if i is not None:
            for j in range(len(t) - length + 1):
                if least[t[j:j + length]] < i:
                    gone[j:j + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), runs, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out
