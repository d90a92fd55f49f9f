"""Quality classifier: logistic regression on hashed word n-grams.

A document's features are its distinct n-grams of one and two words, and of one
to three word shapes (letters and digits by class, a mark for a word that
repeats the one before), hashed to a fixed number of weights.  The weights come
from follow-the-regularised-leader updates, and a score is the sparse dot
product of the document's features with them.
"""

from __future__ import annotations

from .classifier import Classifier
from .common import forget
from .wordgrams import distinct_features, mixed, number, shape, slices

#: Weights of a model; the last is the bias.
SIZE = 1 << 18


def _make(word: str) -> tuple[int, int]:
    return number(word), number(shape(word), 1)


def features(texts):
    """Runs of rows: (first row, document of each feature, features, rows)."""
    import numpy as np

    forget()
    repeat, odd = np.uint64(number("repeat", 2)), np.uint64(0xD6E8FEB86659FD93)
    for row, doc, words, n in slices(texts, _make, 2):
        w, s = words[:, 0], words[:, 1].copy()
        same = doc[1:] == doc[:-1]
        s[1:][same & (w[1:] == w[:-1])] = repeat
        two, s2 = w[:-1] * odd + w[1:], s[:-1] * odd + s[1:]
        s3 = s2[:-1] * odd + s[2:]
        third = same[1:] & same[:-1]
        families = [(doc, mixed(w, 1, SIZE)), (doc[1:][same], mixed(two[same], 2, SIZE)), (doc, mixed(s, 3, SIZE)),
                    (doc[1:][same], mixed(s2[same], 4, SIZE)), (doc[2:][third], mixed(s3[third], 5, SIZE))]
        yield row, *distinct_features(families, n, SIZE), n


#: 1: a text worth keeping.
QUALITY = Classifier(features, SIZE, label="quality", folds=3, held_out=1)
