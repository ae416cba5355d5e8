"""Training-data operators. Nothing outside this folder imports it, except the driver contract, which checks for it."""
