"""Error classes: what the caller must fix, and everything else."""


class ChangeError(Exception):
    """A request that cannot be carried out; the target table is untouched."""


class UserActionError(ChangeError):
    """A failure the owner of the data can resolve (too long a record, duplicate keys, ...)."""


class UnsupportedMigration(ChangeError):
    """The requested kind of migration is not known."""
