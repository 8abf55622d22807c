SELECT codfilial, classificacao, fornecedor, codprod, descricao, numlote, qt::DOUBLE AS quantidade_realizada,
       valor_ultima_entrada::DOUBLE AS valor_ultima_entrada, ROUND(qt * valor_ultima_entrada, 2)::DOUBLE AS total_realizado
FROM (SELECT DISTINCT * EXCLUDE (data_validade) FROM expiring_stock)
