"""A decorator that registers a query with its SQL."""


def registry():
    queries, oracles = {}, {}

    def query(sql: str | None = None):
        def add(run):
            queries[run.__name__] = run
            if sql:
                oracles[run.__name__] = sql
            return run

        return add

    return query, queries, oracles
