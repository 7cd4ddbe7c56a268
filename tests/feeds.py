"""A feed for the live source, in a module of its own so that tasks can import it."""


def feed(conn, generation, cursor):
    """Both connections carry the same 60 frames, a few at a time; the second breaks once."""
    if cursor == 0:
        yield (999.0, "subscribe", "", None, f"g{generation}", None)
    for i in range(max(cursor - 1, 0), 60):
        if conn == 1 and generation == 0 and i == 7:
            raise OSError("broken")
        yield (1000.0 + i, "book", "a", f"h{i}", "s", "{}")
        if i % 5 == 4:
            yield None
