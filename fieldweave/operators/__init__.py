"""DataFrame operators over the data model."""
