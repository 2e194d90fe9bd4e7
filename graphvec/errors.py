"""Errors with the roles that callers tell apart."""


class CollectionNotFound(LookupError):
    """No collection has this name."""


class InvalidValue(ValueError):
    """Arguments that contradict each other or say too little."""


class EngineInitialization(RuntimeError):
    """A store was set up without what it needs."""


class NodesetFilterNotSupported(NotImplementedError):
    """Node-set subgraphs were not asked for as an extension."""
