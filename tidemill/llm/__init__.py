"""Training-data operators at corpus scale (one module per operator); nothing else in the library imports this."""
