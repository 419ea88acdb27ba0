"""Column functions: expression in, expression out, all evaluated in the JVM unless said otherwise."""
