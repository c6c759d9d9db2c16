"""taxaframe.operators"""
