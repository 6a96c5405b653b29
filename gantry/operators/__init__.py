"""DataFrame operators: contract checks, keyed merge, star-schema joins."""
