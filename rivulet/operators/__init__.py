"""DataFrame -> DataFrame transforms; the same for batch and streams unless a docstring says otherwise."""
