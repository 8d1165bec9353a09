"""The five published tables, each one lazy plan."""
