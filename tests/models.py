"""The feed rules said directly, for small inputs."""


def repair(lines, delimiter, width=None):
    """(good, error) of a list of byte lines without line ends.

    Blank lines do not count.  Let *start* be the first line not yet used up.  After line ``j`` the window is
    ``s..j`` for the least ``s >= start`` whose joined lines have at most ``width`` fields.  Exactly
    ``width`` fields make a record; a line that has as many by itself, or more, closes or refuses by itself.
    Lines before ``s``, and all that is left over, are errors.
    """
    kept = [x for x in lines if x.strip(b" \t\n\r\x0b\x0c")]
    if not width:
        width = _fields(lines[:1], delimiter) if lines else 0
    good, used_by = [], {}
    start = 0
    for j, line in enumerate(kept):
        alone = _fields([line], delimiter)
        if alone >= width:
            if alone == width:
                good.append(line)
                used_by[j] = j
            start = j + 1
            continue
        start = next(s for s in range(start, j + 1) if _fields(kept[s:j + 1], delimiter) <= width)
        if _fields(kept[start:j + 1], delimiter) == width:
            good.append(b"".join(kept[start:j + 1]))
            used_by.update((k, j) for k in range(start, j + 1))
            start = j + 1
    return good, [line for k, line in enumerate(kept) if k not in used_by]


def _fields(lines, delimiter):
    return b"".join(lines).count(delimiter) + 1
