SELECT DISTINCT codigo AS cod_filial, razaosocial AS nm_filial FROM pcfilial WHERE codigo <> 99
