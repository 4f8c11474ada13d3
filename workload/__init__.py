"""The supplied tables as monitoring data, and the registered queries over them."""
