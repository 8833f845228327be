"""orrery: catalogue tables in, validated knowledge graphs out, all as lazy Spark plans."""
