"""Suffix sorting by a difference cover (modulo 3), vectorised."""

from __future__ import annotations


def suffix_array(values):
    """The begins of all suffixes of an array of whole numbers from 0, in lexicographic order; a
    suffix that is a beginning of another one comes first.

    The suffixes at two of three positions are sampled: their first three values are sorted and
    named, and while names repeat, the string of names is sorted the same way. The others follow by
    their first value and the sampled rank behind it. Both orders are merged. Positions and ranks
    are held in 32 bits where they fit, and little else is while the names are sorted.
    """
    import numpy as np

    n = len(values)
    if n < 3:
        order = sorted(range(n), key=lambda i: values[i:].tolist())
        return np.array(order, np.int64)
    kind = np.int32 if max(n, int(values.max())) < (1 << 31) - 4 else np.int64
    s = np.zeros(n + 3, kind)
    s[:n] = values
    s[:n] += 1
    # One more sample at the end of a string of length 1 modulo 3, so that names of the two halves
    # of the reduced string cannot be taken for one another.
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3, kind), np.arange(2, n, 3, kind)])
    order, names = _named([s[sample], s[sample + 1], s[sample + 2]], kind)
    if names[order[-1]] + 1 < len(sample):
        del order
        order = suffix_array(names)
    del names
    sorted_sample = sample[order]
    del sample, order
    rank = np.zeros(n + 3, kind)
    rank[sorted_sample] = np.arange(1, len(sorted_sample) + 1)

    zeros = np.arange(0, n, 3, kind)
    zeros = zeros[_named([s[zeros], rank[zeros + 1]], kind)[0]]
    sorted_sample = sorted_sample[sorted_sample < n]
    one = sorted_sample[sorted_sample % 3 == 1]
    two = sorted_sample[sorted_sample % 3 == 2]
    # Where a suffix at 0 modulo 3 stands among the others: it is compared with one at 1 by a value
    # and a rank, and with one at 2 by two values and a rank.
    less = _count_less([s[one], rank[one + 1]], [s[zeros], rank[zeros + 1]])
    less += _count_less([s[two], s[two + 1], rank[two + 2]], [s[zeros], s[zeros + 1], rank[zeros + 2]])
    result = np.empty(n, kind)
    place = less + np.arange(len(zeros))
    others = np.ones(n, bool)
    others[place] = False
    result[place] = zeros
    result[others] = sorted_sample
    return result


def _joined(keys):
    """Several columns of whole numbers as one with the same order."""
    import numpy as np

    whole = keys[0].astype(np.int64)
    for key in keys[1:]:
        size = int(key.max(initial=0)) + 1
        if int(whole.max(initial=0)) >= (1 << 62) // size:
            whole = np.unique(whole, return_inverse=True)[1]
        whole *= size
        whole += key
    return whole


def _named(keys, kind):
    """The order of the rows, and dense names of equal rows in that order, as numbers of ``kind``."""
    import numpy as np

    whole = _joined(keys)
    order = np.argsort(whole, kind="stable").astype(kind)
    names = np.empty(len(whole), kind)
    names[order] = np.cumsum(np.diff(whole[order], prepend=whole[order[:1]]) != 0)
    return order, names


def _count_less(sorted_rows, rows):
    """How many of ``sorted_rows`` are less than each of ``rows``."""
    import numpy as np

    whole = _joined([np.concatenate([a, b]) for a, b in zip(sorted_rows, rows, strict=True)])
    count = len(sorted_rows[0])
    return np.searchsorted(whole[:count], whole[count:], "left")
