"""taxaframe.sources"""
