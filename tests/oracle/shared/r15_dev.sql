SELECT * FROM returns_x r
WHERE r.FILIAL BETWEEN 1 AND 7 AND COALESCE(r.CLASSIFICACAO, 'Não Classificado') = 'FARMA'
