"""Product analytics on Spark: nested event exports in, sessions, funnels, orders and marts out."""
