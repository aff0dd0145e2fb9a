"""candela: a point-in-time adjusted price panel and corpus toolkit on Spark."""
