from datetime import datetime, timezone


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


def rows(df, *columns):
    """Rows as sorted tuples."""
    found = df.select(*columns).collect() if columns else df.collect()
    return sorted([tuple(r) for r in found], key=lambda t: tuple((v is not None, str(v)) for v in t))
