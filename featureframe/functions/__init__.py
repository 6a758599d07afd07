"""Column functions over geometry bytes."""
