"""Plain row-by-row packing, to check the distributed one against."""

from logfreight.model import PackOptions


def fold(rows, limits: PackOptions):
    """``rows``: (key, arrival, size, opening, n_logs) in order. Per row: number, create, close, reason."""
    labels = []
    closing = {}
    package, key, number = None, None, 0

    def close(reason, when):
        closing[(key, package["number"])] = (when, reason)

    for k, arrival, size, opening, n_logs in rows:
        if k != key:
            if package:
                close("flush", package["last"])
            package, key, number = None, k, 0
        if package and arrival >= package["create"] + limits.linger_ms:
            close("linger", package["create"] + limits.linger_ms)
            package = None
        if package:
            total = package["size"] + size
            over = package["logs"] + 1 > limits.max_logs
            package["size"] = total
            if total > limits.max_bytes and total < limits.cap_bytes and not over:
                labels.append((k, package["number"], package["create"]))
                close("size", arrival)
                package = None
                continue
            if total <= limits.max_bytes and not over:
                package["logs"] += n_logs
                package["last"] = arrival
                labels.append((k, package["number"], package["create"]))
                continue
            close("count" if over else "overflow", arrival)
        number += 1
        package = dict(size=opening, logs=n_logs, create=arrival, number=number, last=arrival)
        labels.append((k, number, arrival))
    if package:
        close("flush", package["last"])
    return [(n, c, *closing[(k, n)]) for k, n, c in labels]
