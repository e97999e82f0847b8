"""Writers that give the same table when a batch is written again."""
