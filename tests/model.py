"""Plain statement of the packing rules: the whole token stream in one list, cut by index."""

import hashlib

EOS = 256


def unit(*keys):
    text = "|".join(str(k) for k in keys)
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / float(1 << 52)


def race(records, weights, seed, epochs, horizon):
    """Rows (arrival, source, epoch, doc_id, text) of the first epochs that arrive before the horizon."""
    rows = []
    for source in records:
        pace = len(records[source]) / weights[source] if weights[source] > 0 else None
        for epoch in range(epochs if pace is not None else 0):
            rows += [((epoch + unit(seed, source, epoch, d)) * pace, source, epoch, d, t) for d, t in records[source]]
    return sorted((r for r in rows if r[0] < horizon), key=lambda r: r[:4])


def lay_out(rows, cuts, eos):
    """All tokens of the rows up to their source's cut, and the number of the row that owns each."""
    tokens, owner = [], []
    for k, row in enumerate(rows):
        if row[4] and k <= cuts.get(row[1], k):
            ids = list(row[4].encode()) + ([EOS] if eos else [])
            tokens += ids
            owner += [k] * len(ids)
    return tokens, owner


def settle(rows, caps, seq_len, limit, eos):
    """Cuts of the capped sources: the row whose blocks bring a source to its cap is its last.

    The earliest row that does so does not depend on cuts behind it, so it can be
    taken and the stream laid out anew.
    """
    cuts = {}
    while True:
        tokens, owner = lay_out(rows, cuts, eos)
        n = len(tokens) // seq_len
        n = n if limit is None else min(n, limit)
        closing = [owner[(b + 1) * seq_len - 1] for b in range(n)]
        reached = []
        for source, cap in caps.items():
            own = [k for k in closing if rows[k][1] == source]
            if cap is not None and source not in cuts and len(own) * seq_len >= cap:
                reached.append((own[-(-cap // seq_len) - 1], source))
        if not reached:
            return tokens, owner, closing, cuts
        row, source = min(reached)
        cuts[source] = row


def build(records, weights, caps, seq_len, total_tokens, seed, eos=True):
    """Blocks as (ids, label), the documents used, and the tokens left over."""
    drawn = [s for s in records if weights[s] > 0]
    limit = None if total_tokens is None else -(-total_tokens // seq_len)
    epochs = 1
    while True:
        horizon = min((epochs * len(records[s]) / weights[s] for s in drawn), default=0.0)
        rows = race(records, weights, seed, epochs, float("inf") if limit is None else horizon)
        tokens, owner, closing, cuts = settle(rows, caps, seq_len, limit, eos)
        full = limit is not None and len(closing) == limit
        if limit is None or full or set(drawn) <= set(cuts):
            break
        epochs *= 2
    end = len(closing) * seq_len
    last = owner[end - 1] if full and end else (-1 if full else len(rows))
    used = [rows[k][1:4] for k in sorted(set(owner)) if k <= last]
    blocks = [(tokens[b * seq_len: (b + 1) * seq_len], rows[k][1]) for b, k in enumerate(closing)]
    return blocks, used, [t for t, k in zip(tokens[end:], owner[end:]) if k <= last]
